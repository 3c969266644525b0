"""Registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm import archive, decontam, mixing, ngrams, projections, quality, repeats, simhash, tokens, toxicity
from premia.llm.arrays import prepare
from premia.llm.negative_queries import NEGATIVES_SQL, op12_hard_negatives
from premia.llm.phrase_queries import PHRASES_SQL, op13_phrases
from premia.llm.repair_queries import REPAIR_SQL, op11_repair
from premia.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with SQL that gives the same rows where SQL can express it."""

    def register(build: Query) -> Query:
        @wraps(build)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = prepared
        if oracle is not None:
            ORACLES[name] = oracle
        return prepared

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op10_simhash")
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAM_SQL = rf"""
WITH item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM (SELECT *, least(13, len(w)) AS size FROM item WHERE len(w) > 0))),
grams AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc, (SELECT DISTINCT size FROM windows))),
hits AS (SELECT doc_id, item_id, grams.size, i FROM grams JOIN windows USING (size, gram)),
words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
names AS (
    SELECT doc_id, count(*) AS n_items, array_to_string(list_sort(list(item)), ',') AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""


@query("op2_decontamination", DECONTAM_SQL)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark contamination of every document."""
    marked = decontam.with_contamination(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    )
    found = F.col("contamination")
    return marked.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        decontam.hit_words(found).alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        decontam.is_contaminated(found).alias("contaminated"),
    )


@query("op7_repeats")
def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that repeated strings of 200 bytes cover."""
    marked = repeats.with_repeats(table(spark, folder, "documents").select("doc_id", "text"), 200, "none")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return marked.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        repeats.digest(F.col("kept")).alias("kept_sha256"),
    )


MIXING_SQL = r"""
WITH RECURSIVE sizes AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (
    SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source)),
fill(rest, weights) AS (
    SELECT CAST(sum(source_size) AS HUGEINT), CAST(sum(weight) AS HUGEINT) FROM sources
    UNION
    SELECT (SELECT CAST(sum(source_size) AS HUGEINT) FROM sources)
               - sum(CASE WHEN weight * rest > 3 * source_size * weights THEN 3 * source_size ELSE 0 END),
           sum(CASE WHEN weight * rest > 3 * source_size * weights THEN 0 ELSE weight END)
    FROM sources, fill GROUP BY rest, weights),
level AS (SELECT rest, weights FROM fill ORDER BY weights LIMIT 1),
targets AS (
    SELECT source, source_size,
           CASE WHEN weight * rest > 3 * source_size * weights THEN CAST(3 * source_size AS DOUBLE)
                ELSE CAST(rest AS DOUBLE) * weight / CAST(weights AS DOUBLE) END AS target
    FROM sources, level),
shares AS (
    SELECT *, target / source_size - whole AS share, greatest(target - whole * source_size, 0.0) AS budget
    FROM (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets)),
ranked AS (
    SELECT doc_id, size, source_size, target, whole, budget, s.source,
           CASE WHEN share > 0 THEN u / (1 - u) * ((1 - share) / share) ELSE 0.0 END AS pareto
    FROM (SELECT *, (CAST(CAST('0x' || substr(md5(concat_ws(':', '0', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(source, ''), size)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
                     / 4503599627370496.0 AS u FROM sizes) AS d
    JOIN shares AS s ON d.source IS NOT DISTINCT FROM s.source),
placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY pareto, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM ranked)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN 2 * ahead + size <= 2 * budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""


@query("op9_mixing", MIXING_SQL)
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of every document by the mix of sources."""
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op1_quality")
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, by its text and the rates of its source and its source's language section."""
    scored = quality.with_quality(
        table(spark, folder, "documents").select("doc_id", "text", "source", "lang"), table(spark, folder, "labels")
    )
    return scored.select(
        "doc_id", "source", "lang",
        *[F.round(c, 6).alias(c) for c in ("evidence", "site_prior", "section_posterior", "quality")],
        (F.col("quality") >= 0.5).alias("kept"),
    )


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


VECTORS_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors AS a JOIN vectors AS b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""


@query("op4_projections", VECTORS_SQL)
def op4_projections(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all vectors, label by label."""
    return projections.near_vectors(table(spark, folder, "embeddings"))


ARCHIVE_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (SELECT *, octet_length(encode(html)) AS size FROM payloads),
stored AS (SELECT html, max(page_id) AS largest FROM sized WHERE size >= 1000 GROUP BY html)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(sized.html) AS payload_digest,
       CASE WHEN largest IS NOT NULL AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN largest IS NOT NULL AND page_id <> largest THEN largest END AS refers_to
FROM sized LEFT JOIN stored ON sized.html = stored.html
"""


@query("op3_warc", ARCHIVE_SQL)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages through WARC archives and back."""
    path = scratch_path(spark, "warc")
    archive.write_archive(table(spark, folder, "pages"), path)
    return archive.read_archive(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SCORES_SQL = rf"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
tokens AS (
    SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v, lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS u
    FROM (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM docs)),
words AS (SELECT w, count(*) AS n FROM tokens GROUP BY w),
pairs AS (SELECT v, w, count(*) AS n FROM tokens WHERE v IS NOT NULL GROUP BY v, w),
triples AS (SELECT u, v, w, count(*) AS n FROM tokens WHERE u IS NOT NULL GROUP BY u, v, w),
total AS (SELECT count(*) AS n FROM tokens),
scores AS (
    SELECT doc_id, count(*) AS n_tokens,
           sum(CASE WHEN t.v IS NULL THEN ln(own.n / total.n)
                    WHEN triples.n >= 2 THEN ln(triples.n / before.n)
                    WHEN pairs.n >= 2 THEN ln(pairs.n / context.n) + CASE WHEN t.u IS NULL THEN 0 ELSE ln(0.4) END
                    ELSE ln(own.n / total.n) + CASE WHEN t.u IS NULL THEN 1 ELSE 2 END * ln(0.4) END) AS log_score
    FROM tokens AS t CROSS JOIN total JOIN words AS own ON own.w = t.w
    LEFT JOIN words AS context ON context.w = t.v LEFT JOIN pairs ON pairs.v = t.v AND pairs.w = t.w
    LEFT JOIN pairs AS before ON before.v = t.u AND before.w = t.v
    LEFT JOIN triples ON triples.u = t.u AND triples.v = t.v AND triples.w = t.w GROUP BY doc_id)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, round(coalesce(log_score, 0), 4) AS log_score, round(log_score / n_tokens, 6) AS mean_log_score
FROM docs LEFT JOIN scores USING (doc_id)
"""


@query("op5_language_model", SCORES_SQL)
def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Stupid-backoff scores of all documents by counts of up to three words of all documents."""
    scored = ngrams.score_documents(table(spark, folder, "documents"))
    return scored.select("doc_id", "n_tokens", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    vocabulary = tokens.read_vocabulary(os.environ.get("PREMIA_VOCABULARY", tokens.VOCABULARY))
    return tokens.token_counts(table(spark, folder, "documents"), scratch_path(spark, "tokens"), vocabulary)


query("op11_repair", REPAIR_SQL)(op11_repair)
query("op12_hard_negatives", NEGATIVES_SQL)(op12_hard_negatives)
query("op13_phrases", PHRASES_SQL)(op13_phrases)
