"""Language-model scores by stupid backoff over n-gram counts of the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import LOWER, SPACED, gram_hashes, pieces, span_hashes, word_spans
from premia.session import materialize

# Longest n-grams; n-grams of two words and more that occur less often than this count as unseen; the factor per step back.
ORDER, LEAST_COUNT, BACKOFF = 3, 2, 0.4
# Text bytes of a batch of documents, and distinct n-grams of a bucket, on average.
BATCH_BYTES, BUCKET_GRAMS = 12 << 20, 1_500_000

_REQUEST = pa.schema([("size", pa.int32()), ("bucket", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("batch", pa.int64()), ("size", pa.int32()), ("bucket", pa.int64()), ("totals", pa.binary())])


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys: the first, then the gaps in as few whole bytes as the largest gap needs."""
    gaps = np.diff(keys)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    return bytes([width]) + keys[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    width, first = raw[0], np.frombuffer(raw, np.uint64, 1, 1)
    tail = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(tail), 8), np.uint8)
    gaps[:, :width] = tail
    return np.cumsum(np.concatenate([first, gaps.view(np.uint64).ravel()]))


def _grams(texts: pa.Array, lengths: Sequence[int]) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """Per run of texts: the first text, the word heads of each, and for each length the hash of the gram ending at each word.

    A word with fewer words before it than the gram needs has hash 0.
    """
    for first, _, data, offsets in pieces(texts, 4 << 20):
        starts, ends, heads = word_spans(data, offsets, SPACED)
        words = span_hashes(LOWER[data], starts, ends)
        place = np.arange(len(words)) - np.repeat(heads[:-1], np.diff(heads))
        sizes = []
        for size in lengths:
            if size == 1:
                sizes.append(words)
                continue
            own = np.zeros(len(words), np.uint64)
            own[size - 1 :] = gram_hashes(words, size)
            own[place < size - 1] = 0
            sizes.append(own)
        yield first, heads, sizes


def _texts(table: pa.Table, column: int = 0) -> pa.Array:
    return table.column(column).combine_chunks() if table.num_rows else pa.array([], pa.string())


def _batch_grams(texts: pa.Array, lengths: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-grams of a batch and how often they occur, for each length."""
    parts: list[list] = [[] for _ in lengths]
    for _, _, sizes in _grams(texts, lengths):
        for n, hashes in enumerate(sizes):
            parts[n].append(hashes[hashes > 0])
    return [np.unique(np.concatenate(p) if p else np.empty(0, np.uint64), return_counts=True) for p in parts]


def _cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted keys, and where each begins: a bucket is a range of hashes."""
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(keys)])
    return bucket[first].astype(np.int64), np.append(first, len(keys))


def score_documents(docs: DataFrame, order: int = ORDER, least: int = LEAST_COUNT, backoff: float = BACKOFF,
                    batch_bytes: int = BATCH_BYTES, bucket_grams: int = BUCKET_GRAMS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stupid-backoff score of every document: (doc_id, n_tokens, log_score, mean_log_score).

    Tokens are words between ASCII white space, A-Z lower-cased. All documents are the corpus. A token scores the count
    of its n-gram over the count of its context, for the largest n up to ``order`` whose n-gram occurs ``least`` times; each step
    back costs the factor ``backoff``; a single word scores its share of all tokens. The first tokens of a document have shorter
    contexts and pay nothing for that. log_score is the sum of the logarithms.

    Documents are dealt to batches. A batch reduces its n-grams to distinct hashes with counts, which are shuffled by range of the
    hash as sorted, gap-coded arrays, so a very frequent n-gram is one entry per batch. A bucket adds up the counts of
    all batches (the n-gram count table, partitioned by hash) and answers each batch in the order it asked. The batch then
    joins the counts to its n-grams and sums per document.

    Single words and pairs are counted in one round, each greater length in a round of its own. The answers of a round are stored, which
    removes its requests, so the disk holds the requests of one round at a time. Texts are shuffled once per round and once for the scores.

    NULL and empty texts have no tokens, log_score 0 and no mean. Rows are scored as they come, so NULL and repeated ids do not
    matter. Other columns are not read. An empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = size = 0
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                words += len(word_spans(data, offsets, SPACED)[0])
                size += len(data)
        yield pa.RecordBatch.from_pydict({"words": [words], "size": [size]})

    tokens, size = base.select("text").mapInArrow(count, "words long, size long").agg(F.sum("words"), F.sum("size")).first()
    tokens, size = int(tokens or 0), int(size or 0)
    number = max(16, -(-size // batch_bytes))
    buckets = max(16, -(-tokens // bucket_grams))
    batched = base.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)))

    def asking(lengths: Sequence[int]):
        def ask(key: tuple, table: pa.Table) -> pa.Table:
            rows: dict[str, list] = {name: [] for name in _REQUEST.names}
            for n, (keys, counts) in zip(lengths, _batch_grams(_texts(table, 1), lengths)):
                names, cuts = _cuts(keys, buckets)
                for bucket, a, b in zip(names.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                    for column, value in zip(_REQUEST.names, (n, bucket, key[0].as_py(), packed_keys(keys[a:b]), counts[a:b].astype(np.uint32).tobytes())):
                        rows[column].append(value)
            return pa.Table.from_pydict(rows, schema=_REQUEST)

        return ask

    def add(table: pa.Table) -> pa.Table:
        keys = [unpacked_keys(k) for k in table.column("keys").to_pylist()]
        counts = [np.frombuffer(c, np.uint32) for c in table.column("counts").to_pylist()]
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(where, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)[where]
        ends = np.cumsum([len(k) for k in keys])
        # Sums of more than 32 bits keep 64: the width is told by the length.
        kind = np.uint32 if totals.max(initial=0) < 1 << 32 else np.uint64
        answers = [totals[e - len(k) : e].astype(kind).tobytes() for e, k in zip(ends.tolist(), keys)]
        return pa.Table.from_arrays([table.column("batch"), table.column("size"), table.column("bucket"), pa.array(answers, pa.binary())], schema=_ANSWER)

    def score(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        column = _texts(texts, 1)
        known = _batch_grams(column, range(1, order + 1))
        totals = []
        by_place = {(s, b): t for s, b, t in zip(*(answers.column(c).to_pylist() for c in ("size", "bucket", "totals")))}
        for n, (keys, _) in enumerate(known):
            names, cuts = _cuts(keys, buckets)
            parts = []
            for bucket, a, b in zip(names.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                raw = by_place[n + 1, bucket]
                parts.append(np.frombuffer(raw, np.uint32 if len(raw) == 4 * (b - a) else np.uint64).astype(np.int64))
            totals.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
        logs, counts = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for first, heads, sizes in _grams(column, range(1, order + 1)):
            rows = slice(first, first + len(heads) - 1)
            counts[rows] = np.diff(heads)
            if not len(sizes[0]):
                continue
            seen = [np.where(h > 0, t[np.minimum(np.searchsorted(k, h), len(k) - 1)], 0) if len(k) else np.zeros(len(h), np.int64)
                    for h, (k, _), t in zip(sizes, known, totals)]
            value = np.log(seen[0] / tokens)
            for n in range(2, order + 1):
                # The context of an n-gram is the (n - 1)-gram that ends one word earlier.
                context = np.append(0, seen[n - 2][:-1])
                whole = sizes[n - 1] > 0
                good = whole & (seen[n - 1] >= least)
                value = np.where(good, np.log(np.maximum(seen[n - 1], 1) / np.maximum(context, 1)), np.where(whole, value + np.log(backoff), value))
            sums = np.append(0.0, np.cumsum(value))
            logs[rows] = [float(np.sum(value[a:b])) for a, b in zip(heads[:-1].tolist(), heads[1:].tolist())] if len(heads) < 200_000 else np.diff(sums[heads])
        return pa.table({"doc_id": texts.column(0), "n_tokens": pa.array(counts), "log_score": pa.array(logs)})

    answers = None
    for lengths in [range(1, min(order, 2) + 1)] + [[n] for n in range(3, order + 1)]:
        requests = batched.groupBy("batch").applyInArrow(asking(lengths), "size int, bucket long, batch long, keys binary, counts binary")
        own = materialize(requests.groupBy("size", "bucket").applyInArrow(add, "batch long, size int, bucket long, totals binary"), "answers")
        answers = own if answers is None else answers.union(own)
    scored = batched.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, "doc_id long, n_tokens long, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")))
