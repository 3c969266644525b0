"""The mix of sources: targets, sampling and edge cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from premia.llm.mixing import mix, mixed_copies, placed_rows, source_targets


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * rest > 3 * sizes[s] * free}
        if not over:
            return {s: float(3 * sizes[s]) if s in full else rest * weight[s] / free for s in names}
        full |= over


def test_targets_fill_up_by_weight(llm_spark):
    for sizes in ({"a": 10, "b": 1000, "Z": 5, "é": 100, None: 50, "": 1}, {"a": 1}, {"a": 0, "b": 0}, {"x": 0, "y": 9}):
        frame = llm_spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(frame).collect()}
        assert got == plain_targets(sizes)


def test_mix_meets_targets_and_reruns_agree(llm_spark, small):
    docs = llm_spark.read.parquet(f"{small}/documents.parquet")
    rows = mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "copies").collect()
    assert len(rows) == docs.count()
    assert rows_of(mix(docs)) == rows_of(mix(docs.repartition(3)))
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        assert own[0].source_size == sum(r.size for r in own)
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in rows)


def rows_of(frame):
    return sorted((r.doc_id, r.size, r.target, r.taken) for r in frame.select("doc_id", "size", "target", "taken").collect())


def test_edges(docs_of, llm_spark):
    assert mix(docs_of([(1, "a")]).limit(0)).count() == 0
    pairs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c d e"), (None, "c d e"), (4, "w " * 100_000), (5, "x")]
    docs = docs_of(pairs, source=["a", "a", "b", "b", None, None, "", "c"]).withColumns({c: F.lit(7) for c in ("size", "target", "taken", "copies", "source_size", "weight")})
    rows = mix(docs).collect()
    assert len(rows) == len(pairs)
    assert sum(r.size for r in rows) == 2 + 2 + 3 + 3 + 100_000 + 1
    assert all(r.taken <= 3 * r.size and r.weight == 7 for r in rows)
    copies = mixed_copies(docs)
    assert copies.agg(F.sum("size")).first()[0] == sum(r.taken for r in rows)


def test_capped_source_is_neither_ordered_nor_copied_once_more(docs_of):
    # By weight the first source would get 5/8 of all words, which is above 3 times its 1,000.
    pairs = [(n, "w" if n % 2 else "") for n in range(2000)] + [(2000 + n, "w " * 40) for n in range(300)] + [(3000, ""), (3001, None)]
    docs = docs_of(pairs, source=["a"] * 2000 + ["b", "c", "c"] * 100 + ["d", "d"])
    ordered = {r[0]: r[1] for r in placed_rows(docs, (5, 2, 1), 3, 0, "doc_id", "text", "source").groupBy("source").agg(F.count_if("__ordered")).collect()}
    assert ordered["a"] == 0 and ordered["d"] == 0
    rows = mix(docs).collect()
    assert len(rows) == len(pairs)
    assert {r.copies for r in rows if r.source == "a"} == {3}
    assert all(r.copies <= 3 for r in rows)
    assert {r.copies for r in rows if r.source == "d"} == {1}
    assert mixed_copies(docs).where("source = 'a'").count() == 6000
