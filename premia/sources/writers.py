"""Writing tables and reports, addressed by zone and run date."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from premia.session import file_system, release
from premia.sources.readers import without_nan

# The zones of a store.
ZONES = ["raw", "features", "validated", "models", "predictions", "drift", "failures"]


def write_partitioned(rows: DataFrame, path: str, partition_columns: Sequence[str] = ()) -> str:
    """Replace a Hive-partitioned Parquet table.

    The write asks for a rebalance on the partition columns: small partitions are merged into one
    file, and a value that holds much of the data is split over many tasks and files.
    """
    if partition_columns:
        rows = rows.hint("rebalance", *(F.col(c) for c in partition_columns))
    rows.write.mode("overwrite").partitionBy(*partition_columns).parquet(path)
    return path


def write_report(spark: SparkSession, report: DataFrame | Mapping, path: str) -> str:
    """One JSON document. ``report`` is a one-row frame or a mapping."""
    if not isinstance(report, DataFrame):
        report = spark.createDataFrame([(json.dumps(report, default=str),)], "value STRING")
        report.coalesce(1).write.mode("overwrite").text(path)
        return path
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


@dataclass(frozen=True)
class Staged:
    """A run that is written but not published, with what was measured while it was written."""

    spark: SparkSession
    path: str
    target: str
    metrics: dict

    def publish(self) -> str:
        """Replace the run by what was staged: the old run goes, the staged folder takes its name."""
        at, files = file_system(self.spark, self.target)
        files.delete(at, True)
        files.mkdirs(at.getParent())
        staged, _ = file_system(self.spark, self.path)
        if not files.rename(staged, at):
            raise OSError(f"{self.path} could not be moved to {self.target}")
        return self.target

    def discard(self) -> None:
        release(self.spark, self.path)


def publish_all(staged: Sequence[Staged], check: Callable[[], None] = lambda: None) -> None:
    """Publish runs together if the check passes; otherwise remove all of them and let its error out."""
    try:
        check()
    except Exception:
        for run in staged:
            run.discard()
        raise
    for run in staged:
        run.publish()


@dataclass(frozen=True)
class Store:
    """Tables below one root: ``zone/table/run_date=.../[column=.../]``.

    A run is one folder, so a rerun replaces all of it and a read lists only it. Read from the table's
    folder, the run date is a partition column.
    """

    root: str

    def path(self, zone: str, table: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}")
        return f"{self.root.rstrip('/')}/{zone}/{table}"

    def run_path(self, zone: str, table: str, run_date: str) -> str:
        return f"{self.path(zone, table)}/run_date={run_date}"

    def write(
        self,
        rows: DataFrame,
        zone: str,
        table: str,
        run_date: str,
        partition_columns: Sequence[str] = (),
    ) -> str:
        """Replace one run of a table."""
        return write_partitioned(rows, self.run_path(zone, table, run_date), partition_columns)

    def stage(self, rows: DataFrame, zone: str, table: str, run_date: str, metrics: Mapping[str, Column] = {}, partition_columns: Sequence[str] = ()) -> Staged:
        """Write a run beside the table and measure it on the way; nobody sees it before :meth:`Staged.publish`.

        ``metrics`` are aggregates over the rows, taken while they are written; ``rows`` (their number) is always among them. Values of
        tasks that were repeated count once, since a repeated task replaces what it had observed.
        """
        observed = Observation(f"{zone}-{table}-{uuid.uuid4().hex}")
        measured = rows.observe(observed, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in metrics.items()))
        path = f"{self.root.rstrip('/')}/_staging/{zone}-{table}-{run_date}-{uuid.uuid4().hex}"
        try:
            write_partitioned(measured, path, partition_columns)
        except Exception:
            release(rows.sparkSession, path)
            raise
        return Staged(rows.sparkSession, path, self.run_path(zone, table, run_date), observed.get)

    def update(self, rows: DataFrame, zone: str, table: str, partition_columns: Sequence[str]) -> str:
        """Replace the partitions of a table that the rows belong to, and no others; ``partition_columns`` begins with run_date."""
        if not partition_columns or partition_columns[0] != "run_date":
            raise ValueError("the first partition column of a store is run_date")
        path = self.path(zone, table)
        spread = rows.hint("rebalance", *(F.col(c) for c in partition_columns))
        writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_columns).parquet(path)
        return path

    def table(self, spark: SparkSession, zone: str, table: str) -> DataFrame:
        """All runs of a table; run_date and further partition columns are columns that filters and joins prune by."""
        return without_nan(spark.read.parquet(self.path(zone, table)))

    def read(self, spark: SparkSession, zone: str, table: str, run_date: str) -> DataFrame:
        """One run of a table."""
        return without_nan(spark.read.parquet(self.run_path(zone, table, run_date)))

    def write_report(
        self, spark: SparkSession, report: DataFrame | Mapping, zone: str, name: str, run_date: str
    ) -> str:
        return write_report(spark, report, self.run_path(zone, name, run_date))


def of_runs(table: DataFrame, since: str, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of the runs from ``since`` on whose partition ``key`` is among ``wanted``: the runs are cut when the plan is made,
    the keys when it runs (if ``wanted`` is a filtered table, small enough to be broadcast), and no file of another partition is opened."""
    return table.where(F.col("run_date") >= since).join(wanted.select(key), key, "leftsemi")


def profile_row(name: str, rows: DataFrame, count: int) -> tuple[str, int, str, int]:
    return name, len(rows.columns), ", ".join(f"{c}:{t}" for c, t in rows.dtypes), count


_PROFILE = "table STRING, column_count INT, schema STRING, rows LONG"


def landing_profile(tables: Mapping[str, DataFrame], counts: Mapping[str, int] | None = None) -> DataFrame:
    """(table, column_count, schema, rows) of every landed table.

    ``counts`` are row counts measured while the tables were written; without them the tables are counted, all in one job.
    """
    spark = next(iter(tables.values())).sparkSession
    if counts is None:
        named = [rows.select(F.lit(name).alias("table")) for name, rows in tables.items()]
        together = named[0]
        for more in named[1:]:
            together = together.unionByName(more)
        counts = {r["table"]: r["n"] for r in together.groupBy("table").agg(F.count("*").alias("n")).collect()}
    return spark.createDataFrame([profile_row(name, rows, counts.get(name, 0)) for name, rows in tables.items()], _PROFILE)


def require_counts(counts: Mapping[str, int]) -> None:
    """Fail if a table has been written without rows."""
    empty = [name for name, n in counts.items() if not n]
    if empty:
        raise ValueError(f"refusing to land empty tables: {', '.join(empty)}")


def require_rows(tables: Mapping[str, DataFrame]) -> None:
    """Fail if a table is empty; looks at one row of each."""
    require_counts({name: int(not rows.isEmpty()) for name, rows in tables.items()})


def land(store: Store, tables: Mapping[str, DataFrame], zone: str, run_date: str) -> DataFrame:
    """Write tables as one run and return their profile: one pass over each, and none is published if one is empty."""
    staged: dict[str, Staged] = {}
    try:
        for name, rows in tables.items():
            staged[name] = store.stage(rows, zone, name, run_date)
    except Exception:
        for run in staged.values():
            run.discard()
        raise
    counts = {name: run.metrics["rows"] for name, run in staged.items()}
    publish_all(list(staged.values()), lambda: require_counts(counts))
    return landing_profile(tables, counts)
