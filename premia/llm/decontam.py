"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import (
    ALNUM, LOWER, gram_hashes, grams_at, pieces, span_hashes, window_minima, word_spans,
)
from premia.session import materialize

# Words of a window, and of the k-grams whose minimum is a window's fingerprint.
WINDOW, GRAM = 13, 5
# Most (window, item) pairs that are broadcast at once, some 40 bytes each; more are worked off in blocks.
BLOCK_PAIRS = 500_000

_CONTAMINATION = "struct<n_words:bigint, hits:array<struct<start:bigint, stop:bigint>>, items:array<string>>"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each text."""
    starts, ends, first = word_spans(data, offsets, ALNUM)
    return span_hashes(LOWER[data], starts, ends), first


def _minima(words: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The fingerprint of each window of ``size`` words: the least hash of its grams."""
    gram = min(gram, size)
    return window_minima(gram_hashes(words, gram), size - gram + 1)


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Windows of the benchmark: rows (size, fingerprint, window, item), without repeats.

    An item of fewer words than a window, but not none, is one window of its own size. Windows of each
    size are winnowed with their size as the guaranteed length.
    """
    schema = "size int, fingerprint long, window long, item string"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in pieces(batch.column(1)):
                words, heads = _words(data, offsets)
                for row in range(len(heads) - 1):
                    own = words[heads[row] : heads[row + 1]]
                    size = min(window, len(own))
                    if not size:
                        continue
                    prints = _minima(own, size, gram).view(np.int64)
                    hashes = gram_hashes(own, size).view(np.int64)
                    name = batch.column(0)[first + row].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hashes), size, np.int32)), pa.array(prints), pa.array(hashes), pa.array([name] * len(hashes), pa.string())],
                        names=["size", "fingerprint", "window", "item"],
                    )

    return items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(windows, schema).distinct()


def _index(rows: pa.Table) -> dict[int, tuple]:
    """Per window size: sorted fingerprints, sorted windows, and the items of each window."""
    sizes, prints, windows = (rows.column(c).to_numpy() for c in ("size", "fingerprint", "window"))
    names = np.array(rows.column("item").to_pylist(), dtype=object)
    index = {}
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        hashes = windows[own].view(np.uint64)
        own, hashes = own[(order := np.argsort(hashes, kind="stable"))], hashes[order]
        distinct, first = np.unique(hashes, return_index=True)
        index[int(size)] = (np.unique(prints[own].view(np.uint64)), distinct, np.append(first, len(own)), names[own])
    return index


def _found(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value would stand, and whether it is there."""
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def _scan(data: np.ndarray, offsets: np.ndarray, index: dict[int, tuple], gram: int) -> list[dict]:
    """Contamination of each text against one block of the benchmark."""
    words, heads = _words(data, offsets)
    rows = len(heads) - 1
    text_of = np.repeat(np.arange(rows), np.diff(heads))
    depth = np.zeros(len(words) + 1, np.int64)
    items: dict[int, set] = {}
    for size, (prints, windows, first, names) in index.items():
        least = _minima(words, size, gram)
        if not len(least):
            continue
        # Neighbouring windows share fingerprints: look each up once.
        runs = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        hit = np.repeat(_found(prints, least[runs])[1], np.diff(np.append(runs, len(least))))
        starts = np.flatnonzero(hit & (text_of[: len(least)] == text_of[size - 1 :]))
        at, same = _found(windows, grams_at(words, starts, size))
        starts, at = starts[same], at[same]
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + size, -1)
        for text, window in set(zip(text_of[starts].tolist(), at.tolist())):
            items.setdefault(text, set()).update(n for n in names[first[window] : first[window + 1]] if n is not None)
    covered = np.append(np.cumsum(depth)[:-1] > 0, False)
    before = np.append(False, covered[:-1])
    edge = np.zeros(len(covered), bool)
    edge[heads[heads < len(covered)]] = True
    starts = np.flatnonzero(covered & (~before | edge))
    stops = np.flatnonzero(before & (~covered | edge))
    out = [{"n_words": int(n), "hits": [], "items": sorted(items.get(i, ()))} for i, n in enumerate(np.diff(heads))]
    for a, b in zip(starts.tolist(), stops.tolist()):
        row = int(text_of[a])
        out[row]["hits"].append({"start": a - int(heads[row]), "stop": b - int(heads[row])})
    return out


def with_contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, gram: int = GRAM, block_pairs: int = BLOCK_PAIRS, name: str = "contamination",
) -> DataFrame:
    """The rows of ``docs`` with a struct ``name``: n_words, hits (word spans), items (ids as sorted strings).

    Words are runs of ASCII letters (A-Z lower-cased), digits and all characters beyond ASCII. A word is
    hit if it lies in an occurrence of any benchmark window. Each side keeps the least k-gram hash of
    every sliding window; equal windows have equal fingerprints, so a document fingerprint found among the
    benchmark's is extended to the windows that chose it, and those are compared. Every shared span of
    ``window`` words is found, and shorter items are winnowed at their own length.

    The benchmark is broadcast in blocks of at most ``block_pairs`` windows, one block per pass over the
    documents, so its size is not limited. Nothing of the documents is shuffled; a document's result
    depends on its own text alone, so repeated rows and NULL or repeated ids need no special care.
    NULL and empty texts have no words and no hits. NULL and empty items have no windows. An item with
    NULL id marks words but is not named. Repeated items count once per id. A column called ``name`` is
    replaced; other columns are kept. Empty tables give empty or unmarked rows.
    """
    spark = docs.sparkSession
    pairs = materialize(item_windows(items, item_id, item_text, window, gram), "windows")
    blocks = max(1, -(-pairs.count() // block_pairs))
    none = F.from_json(F.lit(None).cast("string"), _CONTAMINATION)
    rows = docs.withColumn(name, none) if blocks > 1 else docs
    for block in range(blocks):
        part = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block)
        new = _scanner(spark.sparkContext.broadcast(_index(part.toArrow())), gram)(F.col(text))
        if blocks == 1:
            rows = rows.withColumn(name, new)
        else:
            rows = rows.withColumn("__new", new).withColumn(name, _merged(F.col(name), F.col("__new"))).drop("__new")
            rows = materialize(rows, "contamination")
    return rows


def _scanner(index, gram: int):
    """A column function from text to its contamination by one broadcast block."""

    @F.arrow_udf(_CONTAMINATION)
    def contamination(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for _, _, data, offsets in pieces(texts):
                out += _scan(data, offsets, index.value, gram)
            yield pa.array(out, type=_arrow_type())

    return contamination


def _arrow_type() -> pa.DataType:
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    return pa.struct([("n_words", pa.int64()), ("hits", pa.list_(span)), ("items", pa.list_(pa.string()))])


def _merged(old, new):
    """Two blocks' results of the same text as one."""
    spans = F.array_sort(F.concat(F.coalesce(old["hits"], F.array()), new["hits"]))
    empty = F.slice(new["hits"], 1, 0)
    joined = F.aggregate(
        spans, empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= s["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop")
            ))),
        ).otherwise(F.concat(done, F.array(s))),
    )
    items = F.sort_array(F.array_union(F.coalesce(old["items"], F.array().cast("array<string>")), new["items"]))
    return F.struct(new["n_words"].alias("n_words"), joined.alias("hits"), items.alias("items"))


def hit_words(contamination):
    """The number of words hit, of a contamination struct."""
    return F.aggregate(contamination["hits"], F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def is_contaminated(contamination, share: int = 20):
    """Whether at least one in ``share`` words is hit."""
    hits = hit_words(contamination)
    return (hits > 0) & (share * hits >= contamination["n_words"])


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they were."""
    marked = with_contamination(docs, items, text, name="__contamination")
    return marked.where(~is_contaminated(F.col("__contamination"))).select(*[F.col(f"`{c}`") for c in docs.columns])
