"""Repeated passages of words over all documents, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm import phrases

PHRASES_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, i, array_to_string(w[i : i + 34], ' ') AS passage
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
repeated AS (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM windows JOIN repeated USING (passage)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
kept AS (
    SELECT r, count(gone.i) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL), '')) AS kept_sha256
    FROM words LEFT JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that repeated passages of 35 words cover."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = phrases.with_repeated_phrases(documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
