"""Toxicity: held-out accuracy, features, edges."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from premia.llm.toxicity import features, learn_lexicon, toxicity

MID = "/root/testdata/sf0.1"


def test_held_out_accuracy(llm_spark):
    docs = llm_spark.read.parquet(f"{MID}/documents.parquet")
    labels = llm_spark.read.parquet(f"{MID}/labels.parquet")
    out = toxicity(docs, labels)
    rows = out.join(labels.where("toxic is not null"), "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    positives = [r for r in rows if r.toxic == 1]
    assert right > 0.97 and sum(r.predicted for r in positives) / len(positives) > 0.85
    assert all(0 <= r.score <= 1 for r in rows)


def test_lexicon_and_features(llm_spark):
    toxic = [(f"you are such a vile{i} gnarl person number{i}", 1) for i in range(60)]
    clean = [(f"a calm and quiet day number{i} of the week", 0) for i in range(200)]
    lexicon = learn_lexicon(llm_spark.createDataFrame(toxic + clean, "text string, toxic int"))
    assert ("gnarl", 0) in lexicon and ("calm", 0) not in lexicon and ("number7", 0) not in lexicon
    texts = [("you GNARL!!", 1), ("gn@rl here", 2), ("g.n.a.r.l", 3), ("", 4), (None, 5), ("calm words", 6), ("gnarl " + "x " * 20 + "you", 7)]
    frame = llm_spark.createDataFrame(texts, "text string, n int")
    rows = {r.n: r.f for r in frame.select("n", features(F.col("text"), [("gnarl", 0)]).alias("f")).collect()}
    assert rows[1].hits > 0 and rows[1].near_second_person > 0 and rows[1].exclamations > 0 and rows[1].capital_words > 0
    assert rows[2].hits == 0 and rows[2].disguised_hits > 0
    assert rows[3].disguised_hits > 0
    assert all(v == 0 for v in rows[4]) and all(v == 0 for v in rows[5])
    assert rows[6].hits == rows[6].disguised_hits == 0
    assert rows[7].hits > 0 and rows[7].near_second_person == 0


def test_edges(docs_of, llm_spark):
    labels = llm_spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (3, 1), (7, None), (500, 9)], "doc_id long, toxic int"
    )
    pairs = [(i, "gnarl you fool" if i % 3 == 0 else "calm day today") for i in range(60)] + [(None, "gnarl"), (70, None), (71, ""), (71, ""), (72, "calm " * 60_000)]
    docs = docs_of(pairs).withColumns({c: F.lit(1) for c in ("score", "label", "toxic", "margin", "words", "hits")})
    rows = toxicity(docs, labels).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
