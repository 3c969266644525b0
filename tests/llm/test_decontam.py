"""Decontamination against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from premia.llm.decontam import hit_words, is_contaminated, with_contamination, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = [(name, w[i : i + min(13, len(w))]) for name, t in items if (w := words(t)) for i in range(max(1, len(w) - 12))]
    out = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for name, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    if name is not None:
                        names.add(str(name))
        out.append((doc, len(own), len(hit), sorted(names)))
    return sorted(out, key=str)


def ours(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    c = F.col("contamination")
    rows = with_contamination(d, i, **options).select("doc_id", c["n_words"], hit_words(c), c["items"]).collect()
    return sorted(map(tuple, rows), key=str)


def cases():
    random.seed(1)
    vocabulary = ["the", "of", "Ab", "été", "x1", "ÉTÉ", "zz"]
    text = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, text(random.choice([13, 14, 20, 40]))) for i in range(8)]
    items += [(20, "the of"), (21, "rare"), (22, None), (23, ""), (24, "?!"), (None, "unnamed words here"), (25, items[0][1]), (25, items[0][1])]
    docs = [(i, text(60)) for i in range(15)]
    docs += [(30, None), (31, ""), (32, "rare"), (32, "rare"), (None, "unnamed, words here"), (33, " - ".join(items[2][1].split()))]
    docs += [(34, text(30) + "\n" + items[1][1].upper() + " " + text(30)), (35, "a " * 200_000 + items[3][1]), (36, items[4][1][:-4])]
    return docs, items


@pytest.mark.parametrize("block_pairs", [500_000, 40])
def test_equals_brute_force(llm_spark, block_pairs):
    docs, items = cases()
    assert ours(llm_spark, docs, items, block_pairs=block_pairs) == brute(docs, items)


def test_empty_tables(llm_spark):
    docs, items = cases()
    assert ours(llm_spark, [], items) == []
    assert all(n == 0 for _, _, n, _ in ours(llm_spark, docs, []))


def test_filter_keeps_columns_and_clean_rows(docs_of, llm_spark):
    items = llm_spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    long_clean = "clean " * 400 + "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = docs_of([(1, "ONE two three four five six seven eight nine ten eleven twelve thirteen"), (2, "clean"), (3, None), (4, long_clean)]).withColumn("contamination", F.lit("mine"))
    kept = without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert {r.contamination for r in kept.collect()} == {"mine"}


def test_threshold_is_one_in_twenty(llm_spark):
    items = llm_spark.createDataFrame([(1, "needle")], "item_id long, text string")
    docs = llm_spark.createDataFrame([(19, "a " * 19 + "needle"), (20, "a " * 20 + "needle")], "doc_id long, text string")
    rows = with_contamination(docs, items).select("doc_id", is_contaminated(F.col("contamination")).alias("c")).collect()
    assert {r.doc_id: r.c for r in rows} == {19: True, 20: False}
