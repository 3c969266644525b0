"""Hard-negative mining over its whole table, and the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm import negatives

NEGATIVES_SQL = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor, x.vec_id, a.label = x.label AS same, CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
    FROM (SELECT DISTINCT * FROM vectors WHERE vec_id % 50 = 0) AS a JOIN vectors AS x ON len(a.v) = len(x.v) AND x.vec_id <> a.vec_id),
positives AS (
    SELECT anchor, vec_id, score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor AS anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scores AS n ON n.anchor = p.anchor AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of all anchors (ids divisible by 50) among all vectors; ids divisible by 7 get the next label first."""
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    moved = table.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.hard_negatives(moved, F.col("vec_id") % 50 == 0)
