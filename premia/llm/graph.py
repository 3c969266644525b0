"""Connected components of links, on executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.session import release, scratch_path


def components(links: DataFrame) -> DataFrame:
    """The smallest member reachable from each linked node: rows (node, root).

    ``links`` has two columns of one orderable type, a row per link, in any direction, repeats allowed.
    A NULL end or a loop links nothing. Nodes without links are not returned, so no links give no rows.

    Every round hangs the larger neighbours of a node below its smallest neighbour, then every node and
    its smaller neighbours below the smallest of them, until all components are stars. A round has two
    aggregates and two joins on the node, so a node with very many links is spread over tasks, and its
    result is written to shared storage. The number of rounds grows with the logarithm of the nodes.
    """
    spark = links.sparkSession
    a, b = links.columns
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    ).distinct()
    mark = None
    path = None
    while True:
        new_path = scratch_path(spark, "components")
        edges.write.parquet(new_path)
        edges = spark.read.parquet(new_path)
        if path:
            release(spark, path)
        path = new_path
        # An order-free mark of the edges; two sums make an equal mark of different edges unlikely.
        new_mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low") % 1000003), F.bit_xor(F.xxhash64("low", "high"))
        ).first()
        if new_mark == mark or new_mark[0] == 0:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
                edges.select("low", "low").distinct()
            )
        mark = new_mark
        both = edges.union(edges.select("low", "high")).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("low")).select(
            "node", F.least("node", "low").alias("low")
        )
        large = both.where(F.col("other") > F.col("node")).join(least, "node").select(
            F.col("other").alias("high"), "low"
        ).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("root"))
        edges = (
            large.join(least, "high")
            .select(F.explode(F.array(F.struct("low", "root"), F.struct(F.col("high").alias("low"), "root"))).alias("e"))
            .select(F.col("e.low").alias("high"), F.col("e.root").alias("low"))
            .where("high != low")
            .distinct()
        )
