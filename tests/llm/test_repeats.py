"""Repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.llm.queries import op7_repeats
from premia.llm.repeats import listed_spans, longest_previous, repeated_spans, suffix_order, with_repeats, without, without_repeats


def brute(docs, length, first_only):
    raws = [(t or "").encode() for _, t in docs]
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    places = defaultdict(list)
    for i in order:
        for k in range(len(raws[i]) - length + 1):
            places[raws[i][k : k + length]].append((i, k))
    out = []
    for i, raw in enumerate(raws):
        gone = np.zeros(len(raw) + 1, int)
        for k in range(len(raw) - length + 1):
            where = places[raw[k : k + length]]
            if len(where) > 1 and not (first_only and where[0] == (i, k)):
                gone[k] += 1
                gone[k + length - (k + length > len(raw))] -= k + length <= len(raw)
        mask = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            where = places[raw[k : k + length]]
            if len(where) > 1 and not (first_only and where[0] == (i, k)):
                mask[k : k + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~mask])
        runs = int((mask & ~np.append(False, mask[:-1])).sum()) if len(mask) else 0
        out.append((docs[i][0], len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(frame, length, keep, **options):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    rows = with_repeats(frame, length, keep, **options).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()
    return sorted(map(tuple, rows), key=str)


def cases():
    random.seed(7)
    text = lambda n: "".join(random.choice("abcd éü\n") for _ in range(n))
    shared = [text(60), text(45), text(130)]
    docs = [(i, text(50) + random.choice(shared) + text(30) + random.choice(shared)[: random.choice([20, 41, 60])] + text(20)) for i in range(25)]
    docs += [(40, shared[0]), (41, shared[0]), (42, text(20) * 6), (43, "ab" * 100), (44, "ab" * 40), (45, "x" * 39), (46, "x" * 39), (47, None), (48, ""), (49, None), (50, "é" * 60)]
    return docs


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most", [20_000, 3])
def test_equals_brute_force(llm_spark, keep, most):
    docs = cases()
    frame = llm_spark.createDataFrame(docs, "doc_id long, text string")
    assert ours(frame, 40, keep, gram=12, most=most) == brute(docs, 40, keep == "first")


def test_null_and_repeated_ids(llm_spark):
    docs = cases()[:12] + [(None, cases()[3][1] + "tail"), (5, cases()[5][1]), (None, "z" * 90)]
    frame = llm_spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("spans", "kept", "members", "least", "c1", "first", "doc")})
    assert ours(frame, 40, "none", gram=12) == brute(docs, 40, False)


def test_query_on_the_small_table(llm_spark, small):
    docs = [(r.doc_id, r.text) for r in llm_spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op7_repeats(llm_spark, small).collect()), key=str) == brute(docs, 200, False)


def test_empty_table(llm_spark):
    assert with_repeats(llm_spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_text(llm_spark):
    passage = "".join(random.Random(1).choice("abcdefgh ") for _ in range(500))
    noise = "".join(random.Random(2).choices("ijklmnop ", k=1_300_000))
    frame = llm_spark.createDataFrame([(1, noise[:1_048_000] + passage + noise[1_048_000:]), (2, passage)], "doc_id long, text string")
    rows = {r[0]: r[2] for r in ours(frame, 200, "none")}
    assert rows == {1: 500, 2: 500}


def test_cuts_keep_first_copy_and_whole_characters(docs_of):
    passage = "".join(random.Random(3).choices("éüabc ", k=300))
    docs = docs_of([(1, "one " + passage + " end"), (2, "x" + passage + "é"), (3, passage), (4, "")])
    rows = {r.doc_id: (r.text, r.n_chars) for r in without_repeats(docs, 200).collect()}
    assert rows[1][0] == "one " + passage + " end" and rows[4] == ("", 0)
    assert rows[2] == ("xé", 2) and 3 not in rows


def test_longest_previous_factors():
    text = b"abcabcabxabcabaaaaab"
    order, common = suffix_order(np.zeros(len(text), np.int64), [text[i:] for i in range(len(text))], len(text))
    assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))
    shared = lambda a, b: next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
    assert common[1:].tolist() == [shared(text[a:], text[b:]) for a, b in zip(order[1:], order)]
    expected = [max((shared(text[i:], text[j:]) for j in range(i)), default=0) for i in range(len(text))]
    assert longest_previous(order, common, np.arange(len(text))).tolist() == expected


def test_without():
    assert without(b"0123456789", [(0, 2), (5, 6)]) == b"2346789"


@pytest.mark.parametrize("first_only", [False, True])
def test_copies_of_a_text_add_no_spans(llm_spark, first_only):
    """Every copy is joined to the spans of its text, so these must not grow with the copies."""
    random.seed(3)
    part = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    shared = part(150)
    own = [(1, 0, part(40) + shared + part(40)), (2, 0, part(30) + shared + part(60))]

    def spans(copies):
        texts = llm_spark.createDataFrame(own + own[1:] * (copies - 1), "c1 long, c2 int, text string")
        classes = llm_spark.createDataFrame([(a, b, i, t) for i, (a, b, t) in enumerate(own)], "c1 long, c2 int, doc long, text string")
        return sorted(map(tuple, repeated_spans(texts, classes, classes.drop("text"), 60, first_only).collect()))

    few = spans(1)
    assert few and {s[0] for s in few} == ({2} if first_only else {1, 2})
    assert len(spans(30)) == len(spans(2)) <= 2 * len(few)


def test_spans_of_near_copies_grow_with_their_number(llm_spark):
    random.seed(5)
    part = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    shared = part(400)

    def spans(copies):
        rows = llm_spark.createDataFrame([(i, 0, i, part(30) + shared + part(30)) for i in range(copies)], "c1 long, c2 int, doc long, text string")
        return repeated_spans(rows.drop("doc"), rows, rows.drop("text"), 60, True).count()

    assert 0 < spans(40) <= 2.2 * spans(20)


@pytest.mark.parametrize("first_only", [True, False])
def test_spans_are_listed_once_per_text_without_rows_per_occurrence(llm_spark, first_only):
    random.seed(24)
    part = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    shared = part(3000)
    rows = llm_spark.createDataFrame([(i, 0, i, part(30) + shared + part(30)) for i in range(20)] + [(99, 0, 99, part(500))], "c1 long, c2 int, doc long, text string")
    listed = listed_spans(rows.drop("doc"), rows, rows.drop("text"), 60, first_only)
    assert sorted(r.c1 for r in listed.collect()) == list(range(int(first_only), 20))
    assert "LeftAnti" not in listed._jdf.queryExecution().toString()
