"""Repeated passages by longest-previous-factor arrays over sampled suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import flat_texts, mixed, pieces, release_memory, span_hashes, window_minima
from premia.session import materialize

# Bytes of the k-grams whose minimum anchors a window.
GRAM = 32
# Anchors of one bucket on average, and the most contexts of one anchor that one task orders; more of them are counted by hash.
BUCKET_ANCHORS, MOST_ANCHORS = 4000, 20_000
# Windows of a very long text that are anchored at a time: anchor keys have 20 bits for the place.
_CHUNK = (1 << 20) - (1 << 12)

# Column names of the results and of the joins.
_TAKEN = ("n_bytes", "spans", "kept", "c1", "c2", "least", "members")

SPANS = "array<struct<start:bigint, stop:bigint>>"


def _class(text: Column) -> list[Column]:
    """96 bits that stand for a text."""
    return [F.xxhash64(text).alias("c1"), F.hash(F.lit("second"), text).alias("c2")]


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of ``length`` bytes: text, packed place, the anchor's hash, its context's hash.

    A window's anchor is the leftmost of its k-grams with the least hash, so equal windows have equal
    anchors at the same place, wherever they stand. The context of an anchor is all bytes of its windows.
    """
    out = []
    width = length - gram + 1
    starts = np.arange(max(len(data) - gram + 1, 0))
    hashes = span_hashes(data, starts, starts + gram) if len(starts) else np.empty(0, np.uint64)
    place = np.uint64((1 << 20) - 1)
    for low in range(0, max(len(hashes) - width + 1, 0), _CHUNK):
        own = hashes[low : low + _CHUNK + width - 1]
        least = window_minima((own & ~place) | np.arange(len(own), dtype=np.uint64), width)
        window = low + np.arange(len(least))
        text = np.searchsorted(offsets, window, side="right") - 1
        whole = window + length <= offsets[text + 1]
        at = low + (least & place).astype(np.int64)
        window, text, at = window[whole], text[whole], at[whole]
        if not len(window):
            continue
        heads = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
        first, last, at, text = window[heads], window[np.append(heads[1:], len(window)) - 1], at[heads], text[heads]
        context = span_hashes(data, first, last + length)
        out.append((text, packed(first - offsets[text], last - first, at - last), hashes[at], context))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*out))


def packed(first: np.ndarray, more: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """First window start, windows after the first, and the anchor's distance from the last window, as one number."""
    return (first << 20) | (more << 10) | ahead


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 20, (place >> 10) & 1023, place & 1023


def anchor_rows(texts: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """(c1, c2, place, anchor, context) of all windows; ``texts`` has columns c1, c2, text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for row, _, data, offsets in pieces(batch.column(2)):
                text, place, anchor, context = _anchors(data, offsets, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[row + text]) for k in keys] + [pa.array(place), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))],
                    names=["c1", "c2", "place", "anchor", "context"],
                )

    return texts.select("c1", "c2", "text").mapInArrow(find, "c1 long, c2 int, place long, anchor long, context long")


def common_prefixes(texts: list[bytes], depth: int) -> np.ndarray:
    """Longest common prefix of each text with the one before, up to ``depth``; the first has -1."""
    sizes = np.minimum([len(t) for t in texts], depth)
    table = np.zeros((len(texts), depth + 1), np.uint8)
    flat = np.frombuffer(b"".join(t[:depth] for t in texts), np.uint8)
    table[:, :depth][np.arange(depth) < sizes[:, None]] = flat
    differ = np.ones((len(texts), depth + 1), bool)
    differ[1:, :depth] = table[1:, :depth] != table[:-1, :depth]
    out = np.argmax(differ, axis=1)
    out[1:] = np.minimum(out[1:], np.minimum(sizes[1:], sizes[:-1]))
    out[:1] = -1
    return out


def suffix_order(groups: np.ndarray, texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order within groups, and each suffix's common prefix with the one before it (-1: a new group)."""
    raw = groups.astype(">i8").tobytes()
    keys = [raw[8 * i : 8 * i + 8] + t for i, t in enumerate(texts)]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    common = common_prefixes([texts[i] for i in order], depth)
    moved = groups[order]
    common[1:][moved[1:] != moved[:-1]] = -1
    return order, common


def longest_previous(order: np.ndarray, common: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Longest-previous-factor array: for each suffix, its longest common prefix with a suffix of smaller position.

    ``order`` is a suffix order, ``common`` each suffix's common prefix with the one before in it (at most 0: none). The
    best earlier match of a suffix is its nearest smaller position on one of the two sides in suffix order; the common
    prefix with it is the least value on the way.
    """
    out = np.zeros(len(order), np.int64)
    for step in (1, -1):
        sequence = order if step == 1 else order[::-1]
        # common[i] joins order[i - 1] and order[i]; read backwards, order[i] meets order[i + 1].
        joins = common if step == 1 else np.append(-1, common[::-1][:-1])
        stack: list[tuple[int, int]] = []
        for suffix, join in zip(sequence.tolist(), joins.tolist()):
            reach = join
            while stack and stack[-1][0] > position[suffix]:
                reach = min(reach, stack.pop()[1])
            if stack:
                out[suffix] = max(out[suffix], reach)
            stack.append((int(position[suffix]), reach))
    return out


def longest_match(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Each suffix's longest common prefix with any other: its longest previous or longest next factor."""
    position = np.arange(len(order))
    return np.maximum(longest_previous(order, common, position), longest_previous(order, common, -position))


def _repeats_of_bucket(frame: pd.DataFrame, length: int, first_only: bool) -> pd.DataFrame:
    """Spans of one bucket of anchors: rows c1, c2, doc (the text's place among all), place, anchor, context.

    The suffixes at the anchors are put in suffix order, and so are the reversed bytes ahead of them. A window that
    starts ``o`` bytes ahead of its anchor equals the windows of those anchors that share ``o`` bytes ahead and
    ``length - o`` bytes from the anchor on: neighbours in both orders without a shorter common prefix between. In
    such a set the longest previous factor of a window reaches ``length`` if any smaller position is in it.
    """
    frame = frame.drop_duplicates(["c1", "c2", "place"]).sort_values(["doc", "c1", "c2", "place"], kind="stable")
    first, more, ahead = unpacked(frame["place"].to_numpy())
    most = more + ahead  # bytes ahead of the anchor, from the first window on
    texts, groups = frame["context"].tolist(), frame["anchor"].to_numpy()
    right_order, right_common = suffix_order(groups, [t[m:] for t, m in zip(texts, most.tolist())], length)
    left_order, left_common = suffix_order(groups, [t[:m][::-1] for t, m in zip(texts, most.tolist())], int(most.max(initial=0)) + 1)
    n = len(texts)
    # The longest match on either side bounds every window's match: most anchors without a repeat end here.
    reach = longest_match(right_order, right_common) + longest_match(left_order, left_common)
    able = reach >= length
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    rows, starts = [], []
    for o in range(int(ahead.min(initial=0)), int(most.max(initial=-1)) + 1):
        own = np.flatnonzero(able & (ahead <= o) & (o <= most))
        if not len(own):
            continue
        right[right_order] = np.cumsum(right_common < length - o)
        left[left_order] = np.cumsum(left_common < o)
        key = right[own] * (n + 1) + left[own]
        by = np.argsort(key, kind="stable")  # equal windows stay in order of position
        same = np.append(False, key[by][1:] == key[by][:-1])
        hit = same if first_only else same | np.append(same[1:], False)
        rows.append(own[by[hit]])
        starts.append(first[own[by[hit]]] + most[own[by[hit]]] - o)
    row, start = np.concatenate(rows) if rows else np.empty(0, np.int64), np.concatenate(starts) if starts else np.empty(0, np.int64)
    by = np.lexsort((start, row))
    row, start = row[by], start[by]
    heads = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))[: len(row)])
    tails = np.append(heads[1:], len(row))[: len(heads)] - 1
    row, start, stop = row[heads], start[heads], start[tails] + length
    release_memory()
    return pd.DataFrame({"c1": frame["c1"].to_numpy()[row], "c2": frame["c2"].to_numpy()[row], "start": start, "stop": stop})


def repeated_spans(texts: DataFrame, classes: DataFrame, places: DataFrame, length: int, first_only: bool, gram: int = GRAM, most: int = MOST_ANCHORS) -> DataFrame:
    """``listed_spans`` with a row per span: (c1, c2, start, stop)."""
    return listed_spans(texts, classes, places, length, first_only, gram, most).select("c1", "c2", F.inline("spans"))


def listed_spans(texts: DataFrame, classes: DataFrame, places: DataFrame, length: int, first_only: bool, gram: int = GRAM, most: int = MOST_ANCHORS) -> DataFrame:
    """Byte spans covered by repeated strings of ``length`` bytes, overlapping: (c1, c2, spans), a row per text that has any.

    ``texts`` has a row per text: c1, c2 (its identity) and text; ``classes`` a row per distinct text, with doc
    (its place in order) too, and ``places`` the same without the text. A string counts as repeated if it starts anywhere else too, or with
    ``first_only`` if it starts anywhere earlier.

    Windows are anchored by winnowing, so anchors that occur once are done with. Occurrences of an anchor with equal
    contexts are repeats of each other as a whole; only the first of them is compared with other contexts of the anchor. These are dealt to
    buckets by the anchor's hash; a bucket puts its suffixes in order and reads repeats off the longest-previous-factor condition. An anchor
    with more than ``most`` different contexts is left out of the buckets: its windows are grouped by 128-bit hash instead, with
    partial aggregation, which any number of tasks can share.
    """
    anchors = anchor_rows(texts, length, gram)
    spot = F.xxhash64("c1", "c2", "place")
    repeated = materialize(
        anchors.groupBy("anchor").agg(
            F.min(spot).alias("a"), F.max(spot).alias("b"), (F.min("context") == F.max("context")).alias("alike")
        ).where("a != b").select("anchor", "alike"),
        "repeated",
    )
    # Occurrences with equal contexts are one row of the buckets: the first of them. The lower bits of a place tell where the anchor stands.
    members = materialize(anchors.join(repeated.hint("merge"), "anchor").withColumn("inner", F.col("place").bitwiseAND((1 << 20) - 1)), "members")
    if first_only:
        members = members.join(places, ["c1", "c2"])
    else:
        members = members.withColumn("doc", F.lit(0).cast("long"))
    where = F.struct("doc", "c1", "c2", "place")
    same = ["anchor", "context", "inner"]
    firsts = materialize(members.groupBy(*same).agg(F.min(where).alias("stays"), F.count("*").alias("copies"), F.first("alike").alias("alike")), "firsts")
    differing = firsts.where("NOT alike")
    total = differing.count()
    frequent = materialize(
        differing.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most).select("anchor", F.lit(True).alias("frequent")), "frequent"
    )
    differing = differing.join(frequent, "anchor", "left").withColumn("frequent", F.coalesce("frequent", F.lit(False)))
    wanted = differing.groupBy(F.col("stays.c1").alias("c1"), F.col("stays.c2").alias("c2")).agg(
        F.collect_set(F.struct(F.col("stays.place").alias("place"), "anchor", "frequent")).alias("wanted")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_texts(batch.column(3))
            lists = batch.column(4)
            bounds = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1].astype(np.int64)
            fields = [lists.values.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
            for row in range(len(lists)):
                place, anchor, often = (f[bounds[row] : bounds[row + 1]] for f in fields)
                first, more, _ = unpacked(place)
                begin, end = offsets[row] + first, offsets[row] + first + more + length
                for k in range(0, len(place), 20_000):
                    part = slice(k, k + 20_000)
                    context = [data[i:j].tobytes() for i, j in zip(begin[part].tolist(), end[part].tolist())]
                    same = [batch.column(c)[row].as_py() for c in range(3)]
                    size = len(context)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, same[0])), pa.array(np.full(size, same[1], np.int32)), pa.array(np.full(size, same[2])),
                         pa.array(place[part]), pa.array(anchor[part]), pa.array(often[part]), pa.array(context, pa.binary())],
                        names=["c1", "c2", "doc", "place", "anchor", "frequent", "context"],
                    )
            del data, offsets, fields
            release_memory()

    contexts = classes.join(wanted, ["c1", "c2"]).select("c1", "c2", "doc", "text", "wanted").mapInArrow(
        cut, "c1 long, c2 int, doc long, place long, anchor long, frequent boolean, context binary"
    )
    counted = not frequent.isEmpty()
    if counted:
        # Read several times below; without frequent anchors once, and then by the join that deals out the texts for the result too.
        contexts = materialize(contexts, "contexts")
    buckets = max(1, total // BUCKET_ANCHORS)
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets))
    spans = contexts.where("NOT frequent").groupBy(bucket.alias("bucket")).applyInPandas(
        lambda frame: _repeats_of_bucket(frame, length, first_only), "c1 long, c2 int, start long, stop long"
    )
    if counted:
        spans = spans.union(_counted_spans(contexts.where("frequent"), length, first_only))
    # Occurrences behind the first of equal contexts go as a whole, and so does the first if none is to stay. Those that do not go
    # are told by their place. Copies of a text have the same places and are one row here, with the sets of all its places and of
    # those that stay, so no join makes a row for each occurrence.
    staying = firsts if first_only else firsts.where("copies = 1")
    listed = (
        members.select("c1", "c2", "place")
        .unionByName(staying.select("stays.c1", "stays.c2", F.col("stays.place").alias("stays")), allowMissingColumns=True)
        .unionByName(spans.select("c1", "c2", F.struct("start", "stop").alias("span")), allowMissingColumns=True)
        .groupBy("c1", "c2")
        .agg(F.collect_set("place").alias("places"), F.collect_set("stays").alias("stays"), F.collect_list("span").alias("inside"))
    )

    def whole(place: Column) -> Column:
        first = F.shiftright(place, 20)
        return F.struct(first.alias("start"), (first + F.shiftright(place, 10).bitwiseAND(1023) + length).alias("stop"))

    gone = F.transform(F.array_except("places", "stays"), whole)
    return listed.select("c1", "c2", F.concat(gone, "inside").alias("spans")).where(F.size("spans") > 0)


def _counted_spans(contexts: DataFrame, length: int, first_only: bool) -> DataFrame:
    """Spans of very frequent anchors: every window a row of two hashes, grouped over all tasks."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            for row, _, data, offsets in pieces(batch.column(4)):
                starts = np.arange(max(len(data) - length + 1, 0))
                owner = np.searchsorted(offsets, starts, side="right") - 1
                inside = starts + length <= offsets[owner + 1]
                starts, owner = starts[inside], owner[inside]
                first = span_hashes(data, starts, starts + length)
                second = span_hashes(data[::-1], len(data) - starts - length, len(data) - starts)
                own = [k[row + owner] for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[0]), pa.array(own[1].astype(np.int32)), pa.array(own[2]), pa.array(unpacked(own[3])[0] + starts - offsets[owner]),
                     pa.array(first.view(np.int64)), pa.array(mixed(second).view(np.int64))],
                    names=["c1", "c2", "doc", "start", "w1", "w2"],
                )

    rows = contexts.select("c1", "c2", "doc", "place", "context").mapInArrow(
        windows, "c1 long, c2 int, doc long, start long, w1 long, w2 long"
    )
    where = F.struct(F.col("doc"), F.col("c1"), F.col("c2"), F.col("start"))
    # Stored, so that a window found in very many texts can be split over tasks in the join.
    groups = materialize(rows.groupBy("w1", "w2").agg(F.min(where).alias("low"), F.max(where).alias("high")).where("low != high"), "windows")
    hits = rows.join(groups, ["w1", "w2"])
    if first_only:
        hits = hits.where(where != F.col("low"))
    return hits.select("c1", "c2", "start", (F.col("start") + length).alias("stop"))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def _with_spans(docs: DataFrame, length: int, first_only: bool, text: str, doc_id: str, gram: int = GRAM, most: int = MOST_ANCHORS) -> tuple[DataFrame, Column, Column]:
    """The rows of ``docs`` with ``__spans`` (to remove, overlapping), and columns for the text and its bytes."""
    filled = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in _TAKEN], *_class(filled))
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    groups = materialize(
        base.select(number.alias("doc"), "c1", "c2").groupBy("c1", "c2").agg(F.min("doc").alias("least"), F.count("*").alias("members")),
        "classes",
    )
    texts = base.select(filled.alias("text"), "c1", "c2")
    # As an inequality the test stays out of the join's keys; so the texts are dealt out by class once, for this
    # join and for the last one.
    # As merge joins, whatever the size: a broadcast would put the filter ahead of the shuffle, and there would be two of them.
    classes = base.join(groups.hint("merge"), ["c1", "c2"]).where(number <= F.col("least")).select("c1", "c2", F.col("least").alias("doc"), filled.alias("text"))
    places = groups.select("c1", "c2", F.col("least").alias("doc"))
    listed = listed_spans(texts, classes, places, length, first_only, gram, most).withColumnRenamed("spans", "__spans")
    joined = base.join(groups.hint("merge"), ["c1", "c2"]).join(listed, ["c1", "c2"], "left")
    whole = (F.col("members") > 1) if not first_only else number > F.col("least")
    size = F.octet_length(filled).cast("long")
    joined = joined.withColumn("__spans", F.when(whole & (size >= length), F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("stop")))).otherwise(
        F.coalesce("__spans", F.array().cast(SPANS))
    ))
    return joined, filled, size


def with_repeats(docs: DataFrame, length: int = 200, keep: str = "first", text: str = "text", doc_id: str = "doc_id",
                 gram: int = GRAM, most: int = MOST_ANCHORS) -> DataFrame:
    """The rows of ``docs`` with ``n_bytes``, ``spans`` (bytes to remove) and ``kept`` (the bytes left, binary).

    A byte is removed if a string of ``length`` bytes that covers it also starts elsewhere in the table, in
    the same or another text. With ``keep="first"`` the first of equal strings stays, by doc_id and place; with
    ``keep="none"`` all go. Strings never cross texts and are compared on the input. Overlaps count.

    Equal texts are one class: its row with the smallest id is compared with other classes; the others are
    repeats as a whole, if they have ``length`` bytes. NULL and empty texts have no bytes and stay empty. Rows with NULL id
    come before all others; rows that repeat id and text are copies of each other, and with ``keep="first"`` they all
    count as the first. Columns named like the results are replaced, columns named
    c1, c2, least and members are left out, others are kept. Empty table: no rows.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    joined, filled, size = _with_spans(docs, length, keep == "first", text, doc_id, gram, most)

    @F.arrow_udf(f"struct<spans:{SPANS}, kept:binary>")
    def remove(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            data, offsets = flat_texts(texts)
            for row, own in enumerate(lists.to_pylist()):
                union = _union([(s["start"], s["stop"]) for s in own])
                raw = data[offsets[row] : offsets[row + 1]].tobytes()
                out.append({"spans": [{"start": a, "stop": b} for a, b in union], "kept": without(raw, union)})
            del data, offsets
            release_memory()
            yield pa.array(out, pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())]))

    done = joined.withColumn("__done", remove(filled, F.col("__spans")))
    return done.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in _TAKEN],
        size.alias("n_bytes"), F.col("__done.spans").alias("spans"), F.col("__done.kept").alias("kept"),
    )


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside of disjoint spans in order."""
    left, at = [], 0
    for start, stop in spans:
        left.append(raw[at:start])
        at = stop
    return b"".join(left) + raw[at:]


def digest(kept: Column) -> Column:
    """Lower-case hex SHA-256 of bytes."""
    return F.sha2(kept, 256)


def without_repeats(docs: DataFrame, length: int = 200, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with later copies of repeated passages cut out of the text, the first copies kept.

    A cut never splits a character: spans shrink to whole characters. A row whose whole text is cut
    goes; rows that were empty before stay. ``n_chars``, where present, follows the new text.
    """
    # Columns named like the results step aside meanwhile.
    aside = {c: f"__own_{c}" for c in docs.columns if c in _TAKEN}
    joined, _, _ = _with_spans(docs.withColumnsRenamed(aside), length, True, text, doc_id)

    @F.arrow_udf("struct<cut:boolean, after:string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            data, offsets = flat_texts(texts)
            out = []
            for row, own in enumerate(lists.to_pylist()):
                inner = []
                for a, b in _union([(s["start"], s["stop"]) for s in own]):
                    start, end = offsets[row], offsets[row + 1]
                    while a < b and data[start + a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and start + b < end and data[start + b] & 0xC0 == 0x80:
                        b -= 1
                    inner.append((a, b))
                # Texts without repeats stay where they are.
                out.append(without(data[offsets[row] : offsets[row + 1]].tobytes(), inner) if inner else None)
            yield pa.StructArray.from_arrays([pa.array([x is not None for x in out]), pa.array(out, pa.binary()).cast(pa.string())], names=["cut", "after"])
            del data, offsets, out
            release_memory()

    rows = joined.withColumn("__cut", cut(F.coalesce(F.col(text), F.lit("")), F.col("__spans")))
    changed = F.col("__cut.cut")
    rows = rows.where(~changed | (F.length("__cut.after") > 0))
    new = {text: F.when(changed, F.col("__cut.after")).otherwise(F.col(text))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("__cut.after").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.select(*[new.get(c, F.col(f"`{aside.get(c, c)}`")).alias(c) for c in docs.columns])
