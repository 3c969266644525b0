"""Repeated passages of words by sharded Aho-Corasick automata.

Windows of words are grouped by an anchor inside of them, and anchors that occur once are done with. Of the others every distinct
surrounding goes to the shard of its anchor. A shard confirms which windows recur, compiles them into an automaton
and streams the surroundings of all documents through it; what it locates is put back at every place.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import SPACED, flat_texts, gram_hashes, mixed, pieces, powers, release_memory, span_hashes, window_minima, word_spans
from premia.session import materialize

# Words of a window, and of the k-grams whose least hash anchors it.
WINDOW, GRAM = 35, 5
# Words of one shard on average; distinct surroundings of an anchor beyond which its windows are dealt out one by one.
SHARD_WORDS, MOST_CONTEXTS = 60_000, 400
# Words that are anchored at a time: anchor keys have 20 bits for the place.
_CHUNK = (1 << 20) - (1 << 12)

SPANS = "array<struct<start:bigint, stop:bigint>>"


def _run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of word hashes, the same wherever it stands."""
    forward, backward = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum((words | np.uint64(1)) * forward[: len(words)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * backward[starts] + (ends - starts).astype(np.uint64))


def _anchors(words: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows: text, first window's word, windows after the first, the anchor's hash, its context's hash.

    ``words`` are hashes of the words of all texts, ``bounds`` the first word of each (and the end). The context of an
    anchor is all words of its windows.
    """
    width, place, out = window - gram + 1, np.uint64((1 << 20) - 1), []
    hashes = gram_hashes(words, gram)
    for low in range(0, max(len(hashes) - width + 1, 0), _CHUNK):
        own = hashes[low : low + _CHUNK + width - 1]
        least = window_minima((own & ~place) | np.arange(len(own), dtype=np.uint64), width)
        start = low + np.arange(len(least))
        text = np.searchsorted(bounds, start, side="right") - 1
        whole = start + window <= bounds[text + 1]
        start, text, at = start[whole], text[whole], (low + (least & place).astype(np.int64))[whole]
        if not len(start):
            continue
        heads = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
        first, last = start[heads], start[np.append(heads[1:], len(start)) - 1]
        text = text[heads]
        out.append((text, first - bounds[text], last - first, hashes[at[heads]], _run_hashes(words, first, last + window)))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def anchor_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(class, place, anchor, context) of all windows; ``texts`` has columns class and text. place: first word * 256 + windows after the first."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = batch.column(0).to_numpy(zero_copy_only=False)
            for row, _, data, offsets in pieces(batch.column(1)):
                starts, ends, bounds = word_spans(data, offsets, SPACED)
                text, first, more, anchor, context = _anchors(span_hashes(data, starts, ends), bounds, window, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[row + text]), pa.array(first * 256 + more), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))],
                    names=["class", "place", "anchor", "context"],
                )

    return texts.select("class", "text").mapInArrow(find, "class long, place long, anchor long, context long")


def confirmed(pieces_of_shard: list[list[bytes]], counts: list[int], window: int) -> tuple[list[tuple[int, ...]], set[tuple[int, ...]]]:
    """The pieces as numbers of their words, and the windows that occur more than once."""
    numbers: dict[bytes, int] = {}
    coded = [tuple(numbers.setdefault(w, len(numbers)) for w in piece) for piece in pieces_of_shard]
    total: defaultdict[tuple[int, ...], int] = defaultdict(int)
    for piece, count in zip(coded, counts):
        for at in range(len(piece) - window + 1):
            total[piece[at : at + window]] += count
    return coded, {w for w, count in total.items() if count > 1}


def automaton(passages: set[tuple[int, ...]]) -> ahocorasick.Automaton:
    """An Aho-Corasick automaton over word numbers."""
    built = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for passage in passages:
        built.add_word(passage)
    built.make_automaton()
    return built


def located(piece: tuple[int, ...], built: ahocorasick.Automaton) -> list[tuple[int, int]]:
    """Disjoint word spans of a piece that passages of the automaton cover."""
    spans: list[tuple[int, int]] = []
    for end, size in built.iter(piece):
        start = end + 1 - size
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], end + 1)
        else:
            spans.append((start, end + 1))
    return spans


def _shard(table: pa.Table, window: int) -> pa.Table:
    """Spans of one shard: rows anchor, context, offset, copies, words."""
    # Rows that repeat a document as a whole bring the same piece again, with all copies counted in each.
    rows = {(a, c, o): (n, w) for a, c, o, n, w in zip(*[table.column(c).to_pylist() for c in ("anchor", "context", "offset", "copies", "words")])}
    coded, passages = confirmed([w.split(b" ") for _, w in rows.values()], [n for n, _ in rows.values()], window)
    out: list[tuple[int, int, int, int]] = []
    if passages:
        built = automaton(passages)
        for (anchor, context, offset), piece in zip(rows, coded):
            out += [(anchor, context, offset + a, offset + b) for a, b in located(piece, built)]
    release_memory()
    columns = list(zip(*out)) if out else [[]] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor", "context", "start", "stop"])


def repeated_spans(base: DataFrame, numbered: DataFrame, window: int, gram: int, most: int) -> DataFrame:
    """(class, spans): word spans covered by windows that also start elsewhere, overlapping, for every distinct text that has some.

    ``base`` has class, text and number, ``numbered`` the least number of each class: only that row's text is cut.
    """
    texts = base.select("class", "text")
    anchors = anchor_rows(texts, window, gram)
    # Joined by a shuffle at every size, so that its cost grows as the input does.
    several = materialize(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    members = materialize(anchors.join(several.hint("merge"), "anchor"), "members")
    contexts = members.groupBy("anchor", "context").agg(F.count("*").alias("copies"), F.min(F.struct("class", "place")).alias("at"))
    contexts = materialize(contexts.select("anchor", "context", "copies", F.col("at.class").alias("class"), F.col("at.place").alias("place")), "contexts")
    windows = F.col("place").bitwiseAND(255) + window
    size = contexts.agg(F.sum(windows)).first()[0] or 0
    frequent = materialize(contexts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most).select("anchor", F.lit(True).alias("frequent")), "frequent")
    wanted = contexts.join(frequent, "anchor", "left").groupBy("class").agg(
        F.collect_list(F.struct("place", "anchor", "context", "copies", F.coalesce("frequent", F.lit(False)).alias("frequent"))).alias("wanted")
    )
    schema = "route long, anchor long, context long, offset long, copies long, words binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_texts(batch.column(0))
            lists = batch.column(1)
            limits = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
            fields = [f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten()]
            out, held = [], 0
            for row in range(len(lists)):
                own = data[offsets[row] : offsets[row + 1]]
                starts, ends, _ = word_spans(own, np.array([0, len(own)]), SPACED)
                words = [own[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist())]
                for place, anchor, context, copies, frequent in zip(*[f[limits[row] : limits[row + 1]].tolist() for f in fields]):
                    first, more = place >> 8, place & 255
                    for offset in range(more + 1) if frequent else (0,):
                        part = b" ".join(words[first + offset : first + (offset if frequent else more) + window])
                        route = int.from_bytes(_digest(part), "little", signed=True) if frequent else anchor
                        out.append((route, anchor, context, offset, copies, part))
                        held += len(part)
                    if held > 1 << 22:
                        yield _batch(out, names)
                        out, held = [], 0
            if out:
                yield _batch(out, names)
            del data, fields
            release_memory()

    found = base.join(wanted, "class").join(numbered, "class").where(F.col("number") <= F.col("least"))
    shards = max(1, -(-int(size) // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard")
    spans = found.select("text", "wanted").mapInArrow(cut, schema).groupBy(shard).applyInArrow(
        lambda table: _shard(table, window), "anchor long, context long, start long, stop long"
    )
    first = F.shiftright("place", 8)
    hits = members.join(spans, ["anchor", "context"]).select("class", F.struct((first + F.col("start")).alias("start"), (first + F.col("stop")).alias("stop")).alias("span"))
    return hits.groupBy("class").agg(F.collect_set("span").alias("__spans"))


def _digest(part: bytes) -> bytes:
    from hashlib import blake2b

    return blake2b(part, digest_size=8).digest()


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "words" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)


_RESULTS = ("n_words", "n_removed", "spans", "kept")
_MEANWHILE = ("class", "number", "least", "__spans", "__done", "wanted")


def with_repeated_phrases(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id", gram: int = GRAM, most: int = MOST_CONTEXTS) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_removed``, ``spans`` (runs of words to remove) and ``kept`` (the words left, one space between).

    Words are what stands between the six white-space characters of ASCII, unchanged. A word goes if a window of ``window``
    words that covers it also starts elsewhere, in the same or another row; all copies go. Windows do not cross texts and
    are judged on the input. Rows with equal texts are copies of each other, whatever their ids. NULL and empty texts have no words.
    Columns named like the results are replaced, all others kept. Empty table: no rows.
    """
    aside = {c: f"__own_{c}" for c in docs.columns if c in _MEANWHILE}
    filled = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = docs.select(*[c for c in map(_quoted, docs.columns) if c.strip("`") not in _RESULTS]).withColumnsRenamed(aside)
    keyed = own.withColumn("class", F.xxhash64(filled))
    number = F.coalesce(F.col(f"`{aside.get(doc_id, doc_id)}`").cast("long"), F.lit(-(1 << 63)))
    base = keyed.withColumn("number", number).select("class", "number", filled.alias("text"))
    numbered = materialize(base.groupBy("class").agg(F.min("number").alias("least")), "classes")
    listed = repeated_spans(base, numbered, window, gram, most)

    @F.arrow_udf(f"struct<n_words:bigint, n_removed:bigint, spans:{SPANS}, kept:string>")
    def remove(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.string())])
        for texts, lists in batches:
            data, offsets = flat_texts(texts)
            out = []
            for row, spans in enumerate(lists.to_pylist()):
                part = data[offsets[row] : offsets[row + 1]]
                starts, ends, _ = word_spans(part, np.array([0, len(part)]), SPACED)
                gone = np.zeros(len(starts) + 1, np.int64)
                for s in spans or ():
                    gone[s["start"]] += 1
                    gone[s["stop"]] -= 1
                stays = np.cumsum(gone[:-1]) == 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], (~stays).astype(np.int8), [0]])))
                raw = part.tobytes()
                kept = b" ".join([raw[i:j] for i, j in zip(starts[stays].tolist(), ends[stays].tolist())])
                out.append({"n_words": len(starts), "n_removed": int((~stays).sum()), "kept": kept.decode(),
                            "spans": [{"start": int(a), "stop": int(b)} for a, b in zip(edges[::2], edges[1::2])]})
            yield pa.array(out, kind)
            del data, out
            release_memory()

    rows = keyed.join(listed, "class", "left")
    rows = rows.withColumn("__done", remove(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.col("__spans")))
    back = {new: old for old, new in aside.items()}
    return rows.select(
        *[F.col(f"`{c}`").alias(back.get(c, c)) for c in own.columns], *[F.col(f"__done.{c}").alias(c) for c in _RESULTS]
    )


def _quoted(name: str) -> str:
    return f"`{name}`"
