"""Token counts from flat, unindexed token files."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The tokenizer's vocabulary file (ranks of byte strings), and the identifier that ends documents.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50_256
# Words ahead of a document's tokens: whether it has an id, and the id in digits of 15 bits. No word of them equals END.
HEADER, DIGIT_BITS = 6, 15
# Bytes of a block that is searched at once, and documents of one file.
BLOCK_BYTES = 1 << 18
FILE_DOCUMENTS = 4000

# Fixed value: the word pattern of this public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary's bytes, some hundred kilobytes, read by the driver."""
    with open(path, "rb") as file:
        return file.read()


def header(doc_id: int | None) -> list[int]:
    number = 0 if doc_id is None else doc_id & ((1 << 64) - 1)
    return [int(doc_id is not None)] + [number >> (DIGIT_BITS * i) & ((1 << DIGIT_BITS) - 1) for i in range(HEADER - 1)]


def write_tokens(docs: DataFrame, path: str, vocabulary: bytes, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write all documents as flat files of 16-bit words below ``path``: header, tokens and END, one after the other.

    There is no index and no length. NULL and empty texts have no tokens. The vocabulary must not use END, and fit 16 bits.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for name, raw in zip(ids, batch.column(1).to_pylist()):
                tokens = encoding.encode_ordinary(raw) if raw else []
                out.append(np.array(header(name) + tokens, dtype="<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    end = np.array([END], dtype="<u2").tobytes().decode("ISO-8859-1")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, "value binary")
    rows.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", end).option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)


_INNER = "array<struct<doc_id:bigint, n_tokens:bigint>>"
_WORDS = "array<int>"


def _digits_id(words: np.ndarray) -> np.ndarray:
    """Ids of headers, a row each; the flag is not looked at."""
    total = np.zeros(len(words), np.uint64)
    for i in range(HEADER - 1):
        total |= words[:, 1 + i].astype(np.uint64) << np.uint64(DIGIT_BITS * i)
    return total.view(np.int64)


def search_block(words: np.ndarray, end: int = END) -> dict:
    """One block of words: its separators, the words ahead of the first and behind the last, the documents in between."""
    at = np.flatnonzero(words == end)
    if not len(at):
        return {"seps": 0, "head": len(words), "tail": 0, "head_words": words[:HEADER], "tail_words": words[:0], "inner": []}
    starts, sizes = at[:-1] + 1, np.diff(at) - 1
    starts, sizes = starts[sizes >= HEADER], sizes[sizes >= HEADER]
    heads = words[starts[:, None] + np.arange(HEADER)]
    ids = _digits_id(heads)
    inner = [{"doc_id": i if flag else None, "n_tokens": n - HEADER} for i, flag, n in zip(ids.tolist(), heads[:, 0].tolist(), sizes.tolist())]
    return {
        "seps": len(at), "head": int(at[0]), "tail": int(len(words) - at[-1] - 1),
        "head_words": words[: min(at[0], HEADER)], "tail_words": words[at[-1] + 1 :][:HEADER], "inner": inner,
    }


def count_tokens(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Tokens of every document in the flat files below ``path``: (doc_id, n_tokens).

    Files are cut into blocks of ``block_bytes``, an even number. Each block is searched for END in one vectorised pass; documents inside
    are done. What stands ahead of a block's first separator and behind its last is a fragment. A prefix sum of the
    separators over a file's blocks numbers the documents, fragments of one number are added up. A document may span
    any number of blocks. A header is pieced together in the same way. A document without END at a file's end counts; a fragment without a whole header raises.
    """
    raw = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length", "content")
    starts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes))
    blocks = raw.select("path", "content", F.explode(starts).alias("block")).select(
        "path", "block", F.expr(f"substring(content, cast(block * {block_bytes} + 1 as int), {block_bytes})").alias("bytes")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, block, data in zip(*(batch.column(i) for i in range(3))):
                words = np.frombuffer(data.as_buffer(), dtype="<u2")
                found = search_block(words)
                rows.append(found | {"path": path.as_py(), "block": block.as_py(), "head_words": found["head_words"].tolist(), "tail_words": found["tail_words"].tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([
        ("path", pa.string()), ("block", pa.int64()), ("seps", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()),
        ("head_words", pa.list_(pa.int32())), ("tail_words", pa.list_(pa.int32())),
        ("inner", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64())]))),
    ])
    found = blocks.mapInArrow(search, f"path string, block long, seps long, head long, tail long, head_words {_WORDS}, tail_words {_WORDS}, inner {_INNER}")
    inner = found.select(F.explode("inner").alias("d")).select("d.doc_id", "d.n_tokens")
    ahead = F.coalesce(F.sum("seps").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = found.select("path", "block", "seps", "head", "tail", "head_words", "tail_words").withColumn("ahead", ahead)
    fragment = F.explode(F.array(
        F.struct(F.col("ahead").alias("number"), F.lit(0).alias("side"), F.col("head").alias("size"), F.col("head_words").alias("words")),
        F.struct((F.col("ahead") + F.col("seps")).alias("number"), F.lit(1).alias("side"), F.col("tail").alias("size"), F.col("tail_words").alias("words")),
    ))
    fragments = edges.select("path", "block", fragment.alias("f")).where("f.size > 0")
    stitched = fragments.groupBy("path", "f.number").agg(
        F.sum("f.size").alias("size"), F.array_sort(F.collect_list(F.struct("block", F.col("f.side").alias("side"), F.col("f.words").alias("words")))).alias("parts")
    ).withColumn("words", F.slice(F.flatten("parts.words"), 1, HEADER))
    whole = F.when(F.size("words") == HEADER, F.col("words")).otherwise(F.raise_error(F.lit("a token file ends inside a header")).cast(_WORDS))
    number = F.lit(0).cast("long")
    for i in range(HEADER - 1):
        number = number.bitwiseOR(F.shiftleft(F.element_at("words", 2 + i).cast("long"), DIGIT_BITS * i))
    edge = stitched.withColumn("words", whole).select(
        F.when(F.element_at("words", 1) > 0, number).alias("doc_id"), (F.col("size") - HEADER).alias("n_tokens")
    )
    return inner.unionByName(edge)


def token_counts(docs: DataFrame, path: str, vocabulary: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token counts of all documents by way of token files below ``path``: (doc_id, n_tokens), a row per row.

    NULL and empty texts have 0 tokens. NULL ids come back as NULL, repeated rows as often as they came. Other columns are not
    read. An empty table gives no rows.
    """
    write_tokens(docs, path, vocabulary, doc_id, text)
    return count_tokens(docs.sparkSession, path)
