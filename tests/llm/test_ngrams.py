"""Stupid-backoff scores against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.llm import ngrams
from premia.llm.ngrams import packed_keys, score_documents, unpacked_keys


def brute(texts, order, least=2, backoff=0.4):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(t or "").translate(lower).encode().split() for t in texts]
    counts = Counter(tuple(d[i : i + n]) for d in docs for n in range(1, order + 1) for i in range(len(d) - n + 1))
    total = sum(map(len, docs))
    out = []
    for d in docs:
        score = 0.0
        for i in range(len(d)):
            for back, n in enumerate(range(min(order, i + 1), 0, -1)):
                gram = tuple(d[i - n + 1 : i + 1])
                if n == 1 or counts[gram] >= least:
                    score += math.log(counts[gram] / (total if n == 1 else counts[gram[:-1]])) + back * math.log(backoff)
                    break
        out.append((len(d), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_brute_force(llm_spark, order):
    random.seed(8)
    texts = [" ".join(random.choice(["the", "The", "of", "été", "a", "b\n", "c\x0b", "rare" + str(random.randrange(99))]) for _ in range(random.randrange(60))) for _ in range(40)]
    texts += [None, "", " ", "single", "single", "w " * 50_000]
    docs = llm_spark.createDataFrame([(i % 43 if i % 7 else None, t, n) for n, (i, t) in enumerate(enumerate(texts))], "doc_id long, text string, n long")
    docs = docs.withColumns({c: F.lit(1) for c in ("batch", "bucket", "n_tokens")})
    rows = score_documents(docs, order, batch_bytes=2000, bucket_grams=50).collect()
    got = sorted((r.n_tokens, round(r.log_score, 6)) for r in rows)
    assert got == sorted((n, round(s, 6)) for n, s in brute(texts, order))
    assert all((r.mean_log_score is None) == (r.n_tokens == 0) for r in rows)


def test_keys_round_trip():
    for keys in ([5], [0, 1], [7, 2**40, 2**64 - 1], sorted({random.getrandbits(64) for _ in range(500)})):
        keys = np.array(keys, np.uint64)
        assert (unpacked_keys(packed_keys(keys)) == keys).all()


def test_empty_table(llm_spark):
    assert score_documents(llm_spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registered_query_scores_with_trigrams(llm_spark, tmp_path):
    import duckdb

    from premia.llm.queries import ORACLES, QUERIES

    texts = ["a b c", "a b c d", "x b c", "b c e", "a b", "a", "", None, "c a b c a b d"]
    llm_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = [(i, n, round(s, 4)) for i, (n, s) in enumerate(brute(texts, 3))]
    rows = QUERIES["op5_language_model"](llm_spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.log_score) for r in rows) == expected
    theirs = duckdb.connect()
    theirs.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(r[:3] for r in theirs.execute(ORACLES["op5_language_model"]).fetchall()) == expected


def test_requests_of_one_round_are_on_disk_at_a_time(llm_spark, monkeypatch):
    """Stored answers remove their requests; with all lengths in one round the disk held the requests of all."""
    stored = []

    def kept(frame, purpose):
        out = ngrams_materialize(frame, purpose)
        stored.append(sorted(r.size for r in out.select("size").distinct().collect()))
        return out

    ngrams_materialize = ngrams.materialize
    monkeypatch.setattr(ngrams, "materialize", kept)
    texts = ["a b c d", "a b c", "b c d a", "c"]
    docs = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.n_tokens, round(r.log_score, 6)) for r in score_documents(docs, 4, batch_bytes=10).collect())
    assert got == sorted((n, round(s, 6)) for n, s in brute(texts, 4))
    assert stored == [[1, 2], [3], [4]]
