"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.arrays import LOWER, release_memory
from premia.llm.graph import components
from premia.session import materialize

# Members of a bucket that are compared pair by pair; a larger bucket is split by flipped bits.
PAIRED = 48

_LOWER = LOWER.tobytes()


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text as a signed integer.

    A bit is set if over half of the shingles' XXH64 values have it. Texts of fewer words than a shingle
    are one shingle; texts without words (NULL, empty, white space) have fingerprint 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    ends = starts + [len(w) for w in words]
    count = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(64, np.int64)
    for low in range(0, count, 100_000):  # bounds the memory of a very long text
        high = min(low + 100_000, count)
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[low:high].tolist(), ends[low + size - 1 : high + size - 1].tolist())],
            dtype=np.uint64,
        )
        for bit in range(64):
            totals[bit] += np.count_nonzero(hashes & np.uint64(1 << bit))
    bits = np.flatnonzero(2 * totals > count)
    return int(np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)).view(np.int64)) if len(bits) else 0


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """The rows with their SimHash as a long column ``name``, in place of a column of that name."""

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            release_memory()

    return docs.withColumn(name, prints(F.col(text)))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Bit masks such that any two values differing in at most ``radius`` bits agree under one of them.

    Every bit position gets a non-zero vector of radius + 1 bits, every non-zero vector v a mask of the
    positions whose vector has an odd product with v. The vectors of ``radius`` positions do not span
    the space, so some v is orthogonal to them all, and its mask leaves those positions out.
    """
    vectors = [v for v in product((0, 1), repeat=radius + 1) if any(v)]
    return [
        sum(1 << i for i in range(bits) if sum(a * b for a, b in zip(v, vectors[i % len(vectors)])) % 2)
        for v in vectors
    ]


def close_links(prints: DataFrame, radius: int = 2, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) that join all values within ``radius`` bits of each other into components.

    ``prints`` has one long column of distinct values. In every table of the covering family, values
    that agree under the mask share a bucket. The pairs of buckets up to ``paired`` members are compared
    and linked if they are close. In a larger bucket each member stands under every value that it becomes by
    flipping up to radius / 2 of the bits outside the mask; two members share such a value only if they
    are within ``radius`` (rounded up to even) bits, so each links to the least member there. That takes
    a number of rows in proportion to the members, whatever the bucket's size, and loses no connection.
    Only an even radius of 2 is offered for it.
    """
    if radius != 2:
        raise ValueError("buckets of any size are covered for radius 2 only")
    masks = covering_masks(radius)
    key = prints.columns[0]
    tables = F.array(*[
        F.struct(F.lit(i).cast("int").alias("t"), F.col(key).bitwiseAND(F.lit(_signed(m))).alias("k"))
        for i, m in enumerate(masks)
    ])
    members = prints.select(F.col(key).alias("fp"), F.explode(tables).alias("e")).select("fp", "e.t", "e.k")
    sizes = members.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(members.join(sizes, ["t", "k"]), "covering")
    small = members.where(F.col("n") <= paired).select("t", "k", "fp")
    pairs = (
        small.join(small.withColumnRenamed("fp", "other"), ["t", "k"])
        .where((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius))
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )
    flips = F.element_at(F.array(*[
        F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1]) for m in masks
    ]), F.col("t") + 1)
    flipped = members.where(F.col("n") > paired).select(
        "t", "k", "fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("v")
    )
    least = flipped.groupBy("t", "k", "v").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))
    starred = least.where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where("a != b")
    return pairs.union(starred).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint and near-duplicate group: (doc_id, fingerprint, component_id).

    Rows whose fingerprints differ in at most 2 bits are linked; ``component_id`` is the smallest id
    reachable. Equal fingerprints are one class, so a group of copies never forms pairs. Repeated rows
    are returned as often as they come. A row with NULL id takes part and has the group's smallest id,
    which is NULL only if no member has one. Texts without words have fingerprint 0. Other columns of
    ``docs`` are not read, whatever their names. An empty table gives no rows.
    """
    rows = materialize(
        with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").select("doc_id", "fingerprint"),
        "fingerprints",
    )
    classes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(close_links(classes.select("fingerprint")))
    placed = classes.join(roots, classes.fingerprint == roots.node, "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    groups = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = placed.join(groups, "root").select("fingerprint", "component_id")
    return rows.join(labels, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: the smallest id of each group stays.

    Of rows that repeat the smallest id, and of groups without any id, one row stays.
    """
    groups = near_duplicates(docs, doc_id, text)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    one = docs.join(kept.withColumnRenamed("doc_id", "__kept"), F.col(doc_id) == F.col("__kept"), "left_semi")
    repeated = groups.groupBy("doc_id").count().where("count > 1 and doc_id is not null").limit(1).count()
    if repeated:
        one = one.dropDuplicates([doc_id])
    if groups.where("component_id is null").limit(1).count():
        bare = with_fingerprints(docs.where(F.col(doc_id).isNull()), text, "__print")
        lone = groups.where("component_id is null").select(F.col("fingerprint").alias("__hex")).distinct()
        bare = bare.join(lone, F.lower(F.lpad(F.hex("__print"), 16, "0")) == F.col("__hex"), "left_semi")
        one = one.unionByName(bare.dropDuplicates(["__print"]).drop("__print"))
    return one


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value
