"""Repeated passages of words against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from premia.llm import phrases


def brute(docs, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    count = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = {i for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for i in range(k, k + window)}
        runs = sum(i - 1 not in gone for i in gone)
        out.append((doc_id, len(w), len(gone), runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def ours(frame, window, **options):
    rows = phrases.with_repeated_phrases(frame, window, **options).select("doc_id", "n_words", "n_removed", F.size("spans"), "kept").collect()
    return sorted(map(tuple, rows), key=str)


def cases():
    rng = random.Random(7)
    some = lambda n: " ".join(rng.choice("ab cd éü x yz Ab".split()) + rng.choice(["", "", "1", "2"]) for _ in range(n))
    shared = [some(14), some(11), some(40)]
    docs = [(i, some(8) + "\n" + rng.choice(shared) + "\t" + some(5) + " \x0b" + " ".join(rng.choice(shared).split()[: rng.choice([5, 10, 13])]) + " " + some(4)) for i in range(30)]
    docs += [(40, shared[0]), (41, shared[0]), (42, some(5) + " " + " ".join([some(3)] * 9)), (43, "a " * 60), (44, "a " * 11), (45, "b " * 10), (46, "b " * 9), (47, None), (48, ""), (49, " \n"), (50, "é" * 60)]
    return docs


@pytest.mark.parametrize("most", [400, 2])
@pytest.mark.parametrize("shard_words", [60_000, 90])
def test_equals_brute_force(llm_spark, monkeypatch, most, shard_words):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    docs = cases()
    assert ours(llm_spark.createDataFrame(docs, "doc_id long, text string"), 10, gram=3, most=most) == brute(docs, 10)


def test_null_and_repeated_ids_and_clashing_columns(llm_spark):
    docs = cases()[:12] + [(None, cases()[3][1] + " tail"), (5, cases()[5][1]), (None, "z " * 30), (None, "z " * 30)]
    clashing = ("class", "number", "least", "wanted", "spans", "kept", "anchor", "place", "__spans")
    frame = llm_spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(c) for c in clashing})
    assert ours(frame, 10, gram=3) == brute(docs, 10)
    rows = phrases.with_repeated_phrases(frame, 10, gram=3)
    assert [c for c in rows.columns if c in clashing and c not in ("spans", "kept")] == [c for c in clashing if c not in ("spans", "kept")]
    assert rows.where("class = 'class' AND number = 'number' AND least = 'least' AND wanted = 'wanted'").count() == len(docs)


def test_empty_table(llm_spark):
    assert ours(llm_spark.createDataFrame([], "doc_id long, text string"), 35) == []


def test_very_long_text(llm_spark, monkeypatch):
    monkeypatch.setattr(phrases, "_CHUNK", 5000)
    rng = random.Random(1)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(70))
    noise = [f"n{rng.randrange(10**9)}" for _ in range(60_000)]
    docs = [(1, " ".join(noise[:4980]) + " " + passage + " " + " ".join(noise[4980:])), (2, passage), (3, "x " + passage + " y")]
    assert ours(llm_spark.createDataFrame(docs, "doc_id long, text string"), 35) == brute(docs, 35)


def test_automaton_locates_every_window():
    coded, found = phrases.confirmed([b"a b c d e".split(), b"x b c d".split(), b"c d e".split()], [1, 1, 1], 3)
    assert len(found) == 2
    assert [phrases.located(c, phrases.automaton(found)) for c in coded] == [[(1, 5)], [(1, 4)], [(0, 3)]]
    assert phrases.confirmed([b"a b c".split()], [2], 3)[1] == {(0, 1, 2)}
