"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from premia.llm.simhash import close_links, covering_masks, fingerprint, keep_one, near_duplicates


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return "0" * 16
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return f"{value:016x}"


def brute_components(prints):
    """prints: (id, hex). Smallest id reachable over links of at most two bits."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = [int(p, 16) for _, p in prints]
    for i in range(len(prints)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(prints))]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    expected = sorted(zip(*zip(*prints), brute_components(prints)), key=str)
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == expected


def test_masks_cover_every_pair_of_bits():
    masks = covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_whole_small_table(llm_spark, small):
    check(llm_spark.read.parquet(f"{small}/documents.parquet").limit(400))


def test_edges_ties_and_repeats(docs_of):
    random.seed(3)
    base = " ".join(random.choice(["ab", "cd", "éf", "gh", "İj"]) + str(random.randrange(50)) for _ in range(400))
    pairs = [(5, None), (6, ""), (7, " \t\n"), (8, "One"), (9, "one two"), (None, "one TWO"), (None, None), (3, base), (4, base), (4, base)]
    pairs += [(10 + i, base.replace(base.split()[i * 7], "changed")) for i in range(12)]
    pairs += [(40, "a b c"), (41, "a b c"), (42, "x" * 300_000 + " y z")]
    check(docs_of(pairs))


def test_empty_table_and_other_columns(docs_of, llm_spark):
    assert near_duplicates(docs_of([(1, "a")]).limit(0)).count() == 0
    docs = docs_of([(1, "a b c d"), (2, "a b c d")]).withColumns({c: F.lit(1) for c in ("fingerprint", "component_id", "n", "t", "k", "fp")})
    assert {r.component_id for r in near_duplicates(docs).collect()} == {1}


@pytest.mark.parametrize("paired", [2, 48])
def test_large_buckets_lose_no_connection(llm_spark, paired):
    random.seed(5)
    base = random.getrandbits(64)
    values = {base}
    for _ in range(150):
        v = random.choice(sorted(values))
        for _ in range(random.choice([1, 1, 2, 3])):
            v ^= 1 << random.randrange(64)
        values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    from premia.llm.graph import components

    roots = {r.node: r.root for r in components(close_links(llm_spark.createDataFrame([(v,) for v in signed], "v long"), paired=paired)).collect()}
    expected = brute_components([(s, f"{v:016x}") for s, v in zip(signed, values)])
    assert [roots.get(s, s) for s in signed] == expected


def test_keep_one(docs_of):
    docs = docs_of([(4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (9, "other words stay here"), (None, "lone text without id")])
    assert sorted((r.doc_id or 0, r.text) for r in keep_one(docs).collect()) == [
        (0, "lone text without id"), (2, "a b c d"), (9, "other words stay here")
    ]


def test_fingerprint_of_nothing_is_zero():
    assert fingerprint(None) == fingerprint("") == 0
