"""Document quality by hierarchical empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import LOWER, SPACED, pieces, span_hashes, word_spans
from premia.session import materialize

FEATURES = (
    "words", "word_length", "distinct", "top_word", "stutter", "capitals", "digits", "symbols", "exclamations", "bars", "repeated_lines",
)
_STRUCT = "struct<" + ", ".join(f"{f}:double" for f in FEATURES) + ">"

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-!?|"]] = True
_NOT_LINE = np.ones(256, bool)
_NOT_LINE[[10, 13]] = False
_RESULTS = ("evidence", "site_prior", "section_posterior", "quality")
# Evidence of one document lies within this many units of log-odds: a text alone is never beyond doubt.
MOST_EVIDENCE = 12.0


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(flags, dtype=np.int64))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repetition(hashes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the number of distinct hashes, and how often its commonest one occurs."""
    rows = len(heads) - 1
    text = np.repeat(np.arange(rows), np.diff(heads))
    distinct, most = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    if not len(hashes):
        return distinct, most
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])))
    runs = np.diff(np.append(first, len(h)))
    np.add.at(distinct, t[first], 1)
    np.maximum.at(most, t[first], runs)
    return distinct, most


def _measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    size = np.maximum(np.diff(offsets), 1)
    low = LOWER[data]
    starts, ends, heads = word_spans(data, offsets, SPACED)
    words = np.diff(heads)
    some = np.maximum(words, 1)
    hashes = span_hashes(low, starts, ends)
    distinct, most = _repetition(hashes, heads)
    text = np.repeat(np.arange(len(words)), words)
    stutter = np.bincount(text[1:][(hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])], minlength=len(words)) if len(hashes) else np.zeros(len(words))
    line_starts, line_ends, line_heads = word_spans(data, offsets, _NOT_LINE)
    lines = np.diff(line_heads)
    line_distinct, _ = _repetition(span_hashes(data, line_starts, line_ends), line_heads)
    return np.column_stack([
        np.log1p(words), np.diff(np.append(0, np.cumsum(ends - starts))[heads]) / some,
        distinct / some, most / some, stutter / some,
        _per_text(_UPPER[data], offsets) / size, _per_text(_DIGIT[data], offsets) / size, _per_text(_SYMBOL[data], offsets) / size,
        _per_text(data == 33, offsets) / size, _per_text(data == 124, offsets) / size,
        (lines - line_distinct) / np.maximum(lines, 1),
    ]).astype(float)


def features(text: str | Column) -> Column:
    """The features of a text as a struct of doubles. NULL counts as empty; an empty text has zeros."""

    @F.arrow_udf(_STRUCT)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [_measure(data, offsets) for _, _, data, offsets in pieces(texts)]
            rows = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(FEATURES))], names=list(FEATURES))

    return measure(F.col(text) if isinstance(text, str) else text)


def fit_evidence(labelled: DataFrame) -> list[float]:
    """Intercept and coefficients of a logistic regression; ``labelled`` has the struct ``features`` and quality 0 or 1.

    Without rows of both classes there is no evidence: all zeros.
    """
    rows = labelled.where(F.col("quality").isin(0, 1)).select("features.*", F.col("quality").cast("double").alias("label"))
    if rows.select("label").distinct().count() < 2:
        return [0.0] * (len(FEATURES) + 1)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(rows).select("vector", "label")
    model = LogisticRegression(featuresCol="vector", labelCol="label", regParam=1e-3, maxIter=50).fit(vectors)
    return [float(model.intercept), *map(float, model.coefficients)]


def evidence(weights: list[float]) -> Column:
    """Log-odds of good quality by a text's features alone."""
    total = F.lit(weights[0])
    for name, weight in zip(FEATURES, weights[1:]):
        total = total + F.col(f"__features.{name}") * weight
    return F.least(F.greatest(total, F.lit(-MOST_EVIDENCE)), F.lit(MOST_EVIDENCE))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength by the method of moments: how many documents a group's prior mean is worth.

    ``groups`` has n (documents), k (sum of probabilities). The spread of group means beyond what groups of their
    sizes show by chance is the spread of the true rates.
    """
    p = F.col("k") / F.col("n")
    n, squares, spread, chance, count = groups.agg(
        F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("n") * (p - mean) ** 2), F.sum(mean * (1 - mean)), F.count("*")
    ).first()
    if not n or count < 2:
        return 1e6
    free = n - squares / n
    between = max((spread - chance * (count - 1) / count) / free if free > 0 else 0.0, 1e-9)
    return float(min(max(chance / count / between - 1, 1.0), 1e6))


def posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """Rates of good documents per section, shrunk to their host and to all: rows for joining, and the global rate.

    ``scored`` has __site, __section and __p. Returned per (site, section): n, k (the section's documents and
    their summed probabilities), prior (the host's posterior mean without this section) and strength.
    """
    sections = materialize(
        scored.groupBy("__site", "__section").agg(F.count("*").alias("n"), F.sum("__p").alias("k")), "sections"
    )
    total = sections.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = float(total.k / total.n) if total.n else 0.5
    mean = min(max(mean, 1e-4), 1 - 1e-4)
    sites = sections.groupBy("__site").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    site_strength = _strength(sites, F.lit(mean))
    hosts = sites.select(F.col("__site").alias("__host"), F.col("n").alias("host_n"), F.col("k").alias("host_k"))
    both = sections.join(hosts, F.col("__site").eqNullSafe(F.col("__host"))).drop("__host")
    section_strength = _strength(both, (site_strength * mean + F.col("host_k")) / (site_strength + F.col("host_n")))
    prior = (site_strength * mean + F.col("host_k") - F.col("k")) / (site_strength + F.col("host_n") - F.col("n"))
    return both.select(
        F.col("__site").alias("__s"), F.col("__section").alias("__c"), F.col("n").alias("__n"), F.col("k").alias("__k"),
        prior.alias("__prior"), F.lit(section_strength).alias("__strength"),
    ), mean


def with_quality(docs: DataFrame, labels: DataFrame, site: str = "source", section: str = "lang", text: str = "text",
                 doc_id: str = "doc_id", measured: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with evidence (log-odds by the text), site_prior, section_posterior and quality (0 to 1).

    A logistic regression on features of the text, fitted on the labelled documents, gives each document's evidence.
    Summed over all documents it gives rates per section (path) of a site (host): a host's rate is shrunk to the rate of
    all, a section's rate to its host's, with strengths estimated from the data, so sparse sites follow the global prior. A
    document is left out of its own section's rate, and a section out of its own host prior. Quality is the evidence, moved from the global rate's
    log-odds to the section's.

    ``labels`` has doc_id and quality; labels other than 0 and 1 and ids unknown to ``docs`` are left aside, a repeated
    label counts as often as it comes, a NULL id matches nothing. Without labels of both classes the evidence is 0 for all. NULL texts count as
    empty. NULL sites and sections are a site and a section of their own. Columns named like the results are replaced. No rows give
    no rows. ``measured`` may pass the rows to return, if they are other columns of the same documents with ``__features``.
    """
    slim = docs.select(
        F.col(doc_id).alias("__id"), F.col(site).cast("string").alias("__site"), F.col(section).cast("string").alias("__section"),
        features(text).alias("__features"),
    )
    slim = materialize(slim, "features")
    known = labels.select(F.col("doc_id").alias("__known"), "quality").where("__known is not null")
    weights = fit_evidence(slim.join(known, F.col("__id") == F.col("__known")).select(F.col("__features").alias("features"), "quality"))
    scored = slim.withColumn("__p", _sigmoid(evidence(weights)))
    rates, mean = posteriors(scored)
    rates = materialize(rates, "rates")  # a row per section: its size is known when the documents are joined to it
    if measured is None:
        rows = docs.withColumn("__features", features(text))
    else:
        rows = measured
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in _RESULTS], evidence(weights).alias("__e"))
    joined = rows.join(
        rates, F.col(site).cast("string").eqNullSafe(F.col("__s")) & F.col(section).cast("string").eqNullSafe(F.col("__c"))
    )
    own = _sigmoid(F.col("__e"))
    posterior = (F.col("__strength") * F.col("__prior") + F.col("__k") - own) / (F.col("__strength") + F.col("__n") - 1)
    posterior = F.least(F.greatest(posterior, F.lit(1e-6)), F.lit(1 - 1e-6))
    joined = joined.withColumn("__posterior", posterior)
    quality = _sigmoid(F.col("__e") + _logit(F.col("__posterior")) - _logit(F.lit(mean)))
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in ("__e", "__features")],
        F.col("__e").alias("evidence"), F.col("__prior").alias("site_prior"), F.col("__posterior").alias("section_posterior"),
        quality.alias("quality"),
    )


def without_rejected(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose quality is at least ``least``, all columns as they were."""
    # Columns named like the results step aside meanwhile.
    aside = {c: f"__own_{c}" for c in docs.columns if c in _RESULTS}
    scored = with_quality(docs.withColumnsRenamed(aside), labels, **options)
    return scored.where(F.col("quality") >= least).select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
