"""Quality: held-out accuracy, shrinkage, edges."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from premia.llm.quality import _strength, posteriors, with_quality, without_rejected

MID = "/root/testdata/sf0.01"


def test_held_out_accuracy(llm_spark):
    docs = llm_spark.read.parquet(f"{MID}/documents.parquet")
    labels = llm_spark.read.parquet(f"{MID}/labels.parquet").where("quality is not null")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    scored = with_quality(docs, labels.where(~held))
    rows = scored.join(labels.where(held).select("doc_id", F.col("quality").alias("truth")), "doc_id").select("quality", "truth").collect()
    assert len(rows) > 50
    assert sum((r.quality >= 0.5) == (r.truth == 1) for r in rows) / len(rows) > 0.95


def test_posteriors_shrink(llm_spark):
    rows = [("a", "x", 0.9)] * 200 + [("a", "y", 0.8)] * 100 + [("b", "x", 0.1)] * 150 + [("c", "x", 0.5)] + [(None, None, 0.5)]
    rates, mean = posteriors(llm_spark.createDataFrame(rows, "__site string, __section string, __p double"))
    got = {(r["__s"], r["__c"]): r for r in rates.collect()}
    assert len(got) == 5 and math.isclose(mean, sum(p for *_, p in rows) / len(rows))
    assert got["a", "x"]["__n"] == 200 and math.isclose(got["a", "x"]["__k"], 180)
    # A sparse site takes the global rate as its prior; a large one its other sections' rate.
    assert math.isclose(got["c", "x"]["__prior"], mean)
    assert got["a", "x"]["__prior"] > 0.7


def test_strength_by_moments(llm_spark):
    frame = llm_spark.createDataFrame([(100, 90.0), (100, 10.0), (100, 50.0)], "n long, k double")
    assert 1.0 <= _strength(frame, F.lit(0.5)) < 5
    same = llm_spark.createDataFrame([(100, 50.0)] * 5, "n long, k double")
    assert _strength(same, F.lit(0.5)) == 1e6


def test_edges(docs_of, llm_spark):
    labels = llm_spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (99, 7)], "doc_id long, quality int")
    pairs = [(1, "a calm line of words. " * 20), (2, "!! " * 200), (3, None), (4, ""), (None, "\n\n"), (4, ""), (5, "w" * 300_000)]
    docs = docs_of(pairs, source=["a", "a", None, "b", "b", "b", ""]).withColumns({c: F.lit(2) for c in ("quality", "evidence", "n", "k", "features")})
    rows = with_quality(docs, labels).collect()
    assert len(rows) == len(pairs) and all(0 <= r.quality <= 1 and r.n == 2 for r in rows)
    kept = without_rejected(docs, labels)
    assert kept.columns == docs.columns and 1 in {r.doc_id for r in kept.collect()} and all(r.quality == 2 for r in kept.collect())
    assert with_quality(docs.limit(0), labels).count() == 0
    assert without_rejected(docs, labels.limit(0)).count() == len(pairs)
