"""The pipeline's stages against brute force on a small table."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from test_decontam import brute as contamination
from test_mixing import plain_targets
from test_simhash import brute_components, plain_fingerprint

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randrange(3, 9))) for _ in range(400)]
    return [" ".join(r.choices(words, k=r.randrange(40, 90))) + "." for _ in range(n)]


def world(docs_of, spark, tmp_path):
    passage = " ".join(texts(1, 99))
    item = " ".join(texts(1, 98)[0].split()[:30])
    base = texts(40, 1)
    pairs = [(i, t) for i, t in enumerate(base)]
    pairs += [(100, base[3]), (101, base[3]), (102, base[4] + " extra"), (None, base[5])]
    pairs += [(110 + i, texts(1, 50 + i)[0] + "\n" + passage + "\n" + texts(1, 70 + i)[0]) for i in range(3)]
    pairs += [(120, texts(1, 200)[0] + " " + item), (121, item), (130, None), (131, "")]
    bad = [(200 + i, " ".join(w + "!!" for w in t.upper().split())) for i, t in enumerate(texts(12, 5))]
    docs = docs_of(pairs + bad, source=[("a", "b", None)[n % 3] for n in range(len(pairs) + len(bad))])
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1) for i in range(0, 40, 2)] + [(200 + i, 0) for i in range(0, 12, 2)]
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, passage, item


def test_stages_take_effect(docs_of, llm_spark, tmp_path):
    folder, passage, item = world(docs_of, llm_spark, tmp_path)
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet")
    steps = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r[c] for c in DOC_COLUMNS) for r in docs.collect()]
        stage(llm_spark, docs, folder).write.parquet(str(tmp_path / f"o{number}"))
        docs = llm_spark.read.parquet(str(tmp_path / f"o{number}"))
        steps[name] = before, docs.collect()
        if number < 4:
            assert docs.columns == DOC_COLUMNS
    before, after = steps["quality classifier"]
    assert {r.doc_id for r in after if r.doc_id} == {d[0] for d in before if d[0] and not 200 <= d[0] < 300} | ({130, 131} & {r.doc_id for r in after})
    before, after = steps["SimHash near-dedup"]
    prints = [(d[0], plain_fingerprint(d[1])) for d in before]
    keep = {root for (_, _), root in zip(prints, brute_components(prints))}
    assert sorted(r.doc_id for r in after) == sorted(keep)
    before, after = steps["suffix-array dedup"]
    whole = {d[0]: d[1] for d in before}
    left = {r.doc_id: r.text for r in after}
    assert sum(passage in (t or "") for t in whole.values()) == 3 and sum(passage in (t or "") for t in left.values()) == 1
    assert passage in left[110] and all(left[i] == whole[i] for i in left if i < 100)
    before, after = steps["benchmark decontamination"]
    dirty = {d for d, n, h, _ in contamination([(d[0], d[1]) for d in before], [(1, item)]) if h and 20 * h >= n}
    assert dirty and {r.doc_id for r in after} == {d[0] for d in before} - dirty
    before, after = steps["mixing sources to target weights"]
    sizes = Counter()
    for d in before:
        sizes[d[3]] += len((d[1] or "").split())
    targets = plain_targets(dict(sizes))
    taken = Counter()
    for r in after:
        taken[r.source] += r.size
    longest = max(len((d[1] or "").split()) for d in before)
    assert all(abs(taken[s] - t) <= longest / 2 + 1e-6 for s, t in targets.items())
    assert max(Counter((r.doc_id, r.source) for r in after).values()) <= 3


def test_run_equals_the_stages_one_by_one(docs_of, llm_spark, tmp_path):
    folder, _, _ = world(docs_of, llm_spark, tmp_path)
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(llm_spark, docs, folder).write.parquet(str(tmp_path / f"s{number}"))
        docs = llm_spark.read.parquet(str(tmp_path / f"s{number}"))
    rows = lambda frame: sorted((tuple(r) for r in frame.collect()), key=str)
    assert rows(corpus_pipeline.run(llm_spark, folder)) == rows(docs)


def test_empty_documents(docs_of, llm_spark, tmp_path):
    folder, _, _ = world(docs_of, llm_spark, tmp_path)
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(llm_spark, docs, folder).write.parquet(str(tmp_path / f"e{number}"))
        docs = llm_spark.read.parquet(str(tmp_path / f"e{number}"))
    assert docs.count() == 0
