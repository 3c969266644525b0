"""Drift of a stream against a fixed reference.

The reference is cut into bins once; its edges and counts are stored beside the stream's, so reports stay
comparable when the reference table changes. Every micro-batch adds its bin counts to the totals of the batch before it
and stores the sum under its own id; older totals go. So a report reads one small table however long the stream has run, a
repeated batch gives the same totals again, and no past row is read a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from premia.operators.drift import bin_counts_of, edges_frame, psi_from_counts, quantile_edges
from premia.session import file_system, release
from premia.spec import PSI_BINS, PSI_THRESHOLD


def store_baseline(
    reference: DataFrame, features: Sequence[str], path: str, bins: int = PSI_BINS
) -> dict[str, list[float]]:
    """Cut the reference into bins, store edges and counts below ``path``, and return the edges."""
    edges = quantile_edges(reference, features, bins)
    edges_frame(reference.sparkSession, edges).coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")
    bin_counts_of(reference, edges).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")
    return edges


def stream_drift_counts(
    stream: DataFrame,
    edges: dict[str, list[float]],
    output: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Keep (feature, bin, n) of everything seen so far; the last two batches' totals stay, as a batch may be repeated."""

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in stored_batches(spark, output) if n < batch_id]
        counts = bin_counts_of(batch, edges)
        if earlier:
            counts = counts.unionByName(spark.read.parquet(_totals(output, earlier[-1])))
        totals = counts.groupBy("feature", "bin").agg(F.sum("n").alias("n"))
        totals.coalesce(1).write.mode("overwrite").parquet(_totals(output, batch_id))
        for old in earlier[:-1]:
            release(spark, _totals(output, old))

    writer = stream.writeStream.foreachBatch(count_batch).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _totals(output: str, batch_id: int) -> str:
    return f"{output.rstrip('/')}/through-{batch_id}"


def stored_batches(spark: SparkSession, output: str) -> list[int]:
    """Ids of the batches whose totals are stored as a whole, in order."""
    at, files = file_system(spark, output)
    if not files.exists(at):
        return []
    folders = [entry.getPath() for entry in files.listStatus(at)]
    whole = [f.getName() for f in folders if files.exists(f.suffix("/_SUCCESS"))]
    return sorted(int(name.removeprefix("through-")) for name in whole)


def stream_drift_report(
    spark: SparkSession,
    features: Sequence[str],
    counts_path: str,
    baseline_path: str,
    threshold: float = PSI_THRESHOLD,
) -> DataFrame:
    """(feature, psi, drifted) of all batches counted so far, against the stored baseline."""
    edges: dict[str, list[float]] = {}
    for row in spark.read.parquet(f"{baseline_path}/edges").orderBy("feature", "edge_no").collect():
        edges.setdefault(row["feature"], []).append(row["edge"])
    seen = stored_batches(spark, counts_path)
    current = spark.read.parquet(_totals(counts_path, seen[-1])) if seen else spark.createDataFrame([], "feature STRING, bin INT, n LONG")
    measured = psi_from_counts(spark.read.parquet(f"{baseline_path}/counts"), current, edges, features)
    return measured.withColumn("drifted", F.col("psi") > F.lit(threshold))
