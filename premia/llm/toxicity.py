"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import ALNUM, LOWER, SPACED, pieces, span_hashes, word_spans
from premia.session import materialize

# Labelled rows that the lexicon, the trees and the calibration learn from, and the most lexicon entries.
TRAINING_ROWS = 20_000
LEXICON_ENTRIES = 1_000
# Lengths in bytes of the word beginnings that may stand in the lexicon, besides whole words.
BEGINNINGS = (4, 5, 6)
# Words from a second-person word within which a lexicon hit counts as near.
NEAR = 5
TREES, DEPTH = 20, 4

# Second-person words of the four languages.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros vuestro su"
).split()
# Characters that stand for letters in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

FEATURES = (
    "words", "hits", "hit_density", "beginning_hits", "beginning_density", "disguised_hits", "disguised_density",
    "near_second_person", "near_density", "second_person", "capitals", "capital_words", "punctuation", "exclamations", "mixed_words",
)
_STRUCT = "struct<" + ", ".join(f"{f}:double" for f in FEATURES) + ">"

_PLAIN = LOWER.copy()
for _from, _to in DISGUISES.items():
    _PLAIN[ord(_from)] = ord(_to)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_STAYS = ~_MARK
_STAYS[[ord(c) for c in DISGUISES]] = True


def _hash_of(text: str) -> np.uint64:
    raw = np.frombuffer(text.encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def _member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes


def _count(text: np.ndarray, flags: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(text[flags], minlength=rows).astype(float)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(flags, dtype=np.int64))
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)


def _measure(data: np.ndarray, offsets: np.ndarray, words_known: np.ndarray, beginnings_known: dict, persons: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    low = LOWER[data]
    starts, ends, heads = word_spans(data, offsets, ALNUM)
    words = np.diff(heads)
    some = np.maximum(words, 1)
    text = np.repeat(np.arange(rows), words)
    hashes = span_hashes(low, starts, ends)
    hit = _member(hashes, words_known)
    begins = np.zeros(len(hashes), bool)
    for size, known in beginnings_known.items():
        long = ends - starts >= size
        begins[long] |= _member(span_hashes(low, starts[long], starts[long] + size), known)
    person = np.flatnonzero(_member(hashes, persons))
    toxic = np.flatnonzero(hit | begins)
    near = np.zeros(rows)
    if len(person) and len(toxic):
        after = np.minimum(np.searchsorted(person, toxic), len(person) - 1)
        before = np.maximum(after - 1, 0)
        gap = np.full(len(toxic), 1 << 40)
        for side in (before, after):
            other = person[side]
            gap = np.where(text[other] == text[toxic], np.minimum(gap, np.abs(other - toxic)), gap)
        near = np.bincount(text[toxic], weights=np.where(gap <= NEAR, 1.0, 0.0), minlength=rows)
    # Disguised: digits and signs read as letters, other marks inside left out, so that a lexicon word appears.
    kept = _STAYS[data]
    plain = _PLAIN[data[kept]]
    new_offsets = np.append(0, np.cumsum(kept, dtype=np.int64))[offsets]
    p_starts, p_ends, p_heads = word_spans(plain, new_offsets, SPACED)
    p_text = np.repeat(np.arange(rows), np.diff(p_heads))
    p_hit = _count(p_text, _member(span_hashes(plain, p_starts, p_ends), words_known), rows)
    hits, begin_hits = _count(text, hit, rows), _count(text, begins, rows)
    disguised = np.maximum(p_hit - hits, 0)
    upper = np.append(0, np.cumsum(_UPPER[data], dtype=np.int64))
    digit = np.append(0, np.cumsum(_DIGIT[data], dtype=np.int64))
    letter = np.append(0, np.cumsum(_LETTER[data], dtype=np.int64))
    shouted = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)
    has_digit = (digit[ends] > digit[starts]) & (letter[ends] > letter[starts])
    letters = np.maximum(_per_text(_LETTER[data], offsets), 1)
    size = np.maximum(np.diff(offsets), 1)
    return np.column_stack([
        np.log1p(words), np.log1p(hits), hits / some, np.log1p(begin_hits), begin_hits / some, np.log1p(disguised), disguised / some,
        np.log1p(near), near / some, np.bincount(text[person], minlength=rows) / some,
        _per_text(_UPPER[data], offsets) / letters, _count(text, shouted, rows) / some, _per_text(_MARK[data], offsets) / size,
        _per_text(data == 33, offsets) / size, _count(text, has_digit, rows) / some,
    ]).astype(float)


def features(text: Column, lexicon: list[tuple[str, int]]) -> Column:
    """The features of a text. ``lexicon``: (entry, 0) for a whole word, (entry, n) for a beginning of n bytes."""
    words = np.sort(np.array([_hash_of(w) for w, n in lexicon if not n], np.uint64))
    beginnings = {}
    for size in BEGINNINGS:
        if own := [int(h) for h, n in lexicon if n == size]:
            beginnings[size] = np.sort(np.array(own, np.int64).view(np.uint64))
    persons = np.sort(np.array([_hash_of(w) for w in SECOND_PERSON], np.uint64))

    @F.arrow_udf(_STRUCT)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [_measure(data, offsets, words, beginnings, persons) for _, _, data, offsets in pieces(texts)]
            rows = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(FEATURES))], names=list(FEATURES))

    return measure(text)


def learn_lexicon(sample: DataFrame, most: int = LEXICON_ENTRIES) -> list[tuple[str, int]]:
    """Words and word beginnings that mark toxic texts; ``sample`` has text and toxic (0 or 1).

    An entry must occur in toxic texts far oftener than chance allows among so many candidates (a binomial
    bound, corrected for their number); the ``most`` clearest are kept. Counts are summed by Spark, the entries come to the driver.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)
            for first, _, data, offsets in pieces(batch.column(0)):
                low = LOWER[data]
                starts, ends, heads = word_spans(data, offsets, ALNUM)
                raw = low.tobytes()
                hashes = {0: span_hashes(low, starts, ends)}
                for size in BEGINNINGS:
                    hashes[size] = np.where(ends - starts > size, span_hashes(low, starts, np.minimum(starts + size, ends)), np.uint64(0))
                for row in range(len(heads) - 1):
                    label = int(toxic[first + row])
                    for size, all_hashes in hashes.items():
                        own = all_hashes[heads[row] : heads[row + 1]]
                        distinct, where = np.unique(own, return_index=True)
                        if size:
                            seen.update((str(h), size, label) for h in distinct[distinct > 0].view(np.int64).tolist())
                        else:
                            for i in (heads[row] + where).tolist():
                                seen[(raw[starts[i] : ends[i]].decode("utf-8", "replace"), 0, label)] += 1
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([seen[k] if k[2] else 0 for k in keys], pa.int64()), pa.array(list(seen.values()), pa.int64())],
                names=["entry", "size", "toxic", "texts"],
            )

    texts, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == texts:
        return []
    totals = materialize(
        sample.select("text", F.col("toxic").cast("int")).mapInArrow(counts, "entry string, size int, toxic long, texts long")
        .groupBy("entry", "size").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts")), "lexicon"
    )
    rate = toxic / texts
    share = (F.col("toxic") + 0.5) / (F.col("texts") + 1)
    gain = F.col("texts") * (share * F.log(share / rate) + (1 - share) * F.log((1 - share) / (1 - rate)))
    bound = math.log(max(totals.count(), 1)) + 2
    clear = totals.where((share > max(0.5, rate)) & (F.col("toxic") >= 3)).withColumn("gain", gain).where(F.col("gain") > bound)
    return [(r.entry, r.size) for r in clear.orderBy(F.desc("gain"), "entry", "size").limit(most).collect()]


def fold(doc_id: str | Column) -> Column:
    """The remainder by 5 of the CRC-32 of an id as text; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % 5


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = TRAINING_ROWS,
             trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Toxicity of every text: (doc_id, held_out, score, predicted), a row per row of ``docs``.

    The lexicon is learned on a bounded sample of labelled rows outside the held-out fold (``rows``, picked by hash of the
    id). Boosted trees over its densities, nearness to second-person words, capitals, punctuation and disguised words are
    trained on three quarters of the sample and calibrated by isotonic regression on the rest. Only the text enters a score.

    Labels other than 0 and 1, and ids not in ``docs``, are left aside. Without labels of both classes the score is the share
    of toxic labels, or 0. Empty and NULL texts are scored by the same trees. A NULL id is not held out and has no label. Repeated rows score alike. Other columns
    are not read. An empty table gives no rows.
    """
    sampled = (
        labels.select(F.col("doc_id").alias("__known"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("__known").isNotNull() & F.col("toxic").isin(0, 1) & (fold("__known") != 0))
        .orderBy(F.xxhash64("__known"), "__known", "toxic").limit(rows)
    )
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # At most `rows` short rows: safe to broadcast.
    sample = materialize(base.join(F.broadcast(sampled), F.col("doc_id") == F.col("__known")).select("doc_id", "text", "toxic"), "sample")
    lexicon = learn_lexicon(sample)
    texts, positives = sample.agg(F.count("*"), F.sum("toxic")).first()
    measured = base.select("doc_id", features(F.col("text"), lexicon).alias("f")).select("doc_id", "f.*")
    held_out = F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out")
    if not positives or positives == texts:
        level = float(positives or 0) / texts if texts else 0.0
        return base.select("doc_id", held_out, F.lit(level).alias("score"), F.lit(int(level >= 0.5)).alias("predicted"))
    train = materialize(
        sample.select("doc_id", "toxic", features(F.col("text"), lexicon).alias("f")).select("doc_id", F.col("toxic").cast("double").alias("label"), "f.*"),
        "training",
    )
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    vectors = assembler.transform(train)
    calibration = fold("doc_id") == 1
    part = vectors.where(~calibration)
    if part.agg(F.count_distinct("label")).first()[0] < 2 or vectors.where(calibration).agg(F.count_distinct("label")).first()[0] < 2:
        part, rest = vectors, vectors
    else:
        rest = vectors.where(calibration)
    boosted = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, cacheNodeIds=False).fit(part)
    margin = F.element_at(_to_array("rawPrediction"), 2)
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(
        boosted.transform(rest).select(margin.alias("margin"), "label")
    )
    ranked = boosted.transform(assembler.transform(measured)).select("doc_id", margin.alias("margin"))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return isotonic.transform(ranked).select("doc_id", held_out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def _to_array(column: str) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)
