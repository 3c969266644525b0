"""Staged runs, partition updates and pruning, and numbering without a driver."""

from __future__ import annotations

import os
import pathlib

import pytest
from pyspark.sql import functions as F
from test_plans import SPEC, clean

from premia.operators.contract import ContractViolation
from premia.operators.ordering import numbered, sequential_id
from premia.plans.validation import run_validation
from premia.sources.writers import Store, land, of_runs


def visible(root):
    """Folders of runs with files, and anything left behind in staging."""
    return sorted({str(p.parent.relative_to(root)) for p in pathlib.Path(root).rglob("part-*")})


def counted(spark, rows, column="sale_id"):
    """The rows with an accumulator that counts how often they are evaluated."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def count(value):
        seen.add(1)
        return value

    return rows.withColumn(column, count.asNondeterministic()(F.col(column))), seen


def test_a_valid_run_is_one_pass_and_published(spark, tmp_path):
    store, run_date = Store(str(tmp_path)), "2025-01-01"
    store.write(spark.range(5), "raw", "sales", run_date)
    features, seen = counted(spark, clean(spark))
    run_validation(store, spark, run_date, SPEC, features)
    assert seen.value == 5
    assert store.read(spark, "validated", "features", run_date).count() == 5
    report = spark.read.json(store.run_path("validated", "validation_report", run_date)).first()
    assert (report["input_row_count"], report["output_row_count"], report["row_retention_pct"], report["status"]) == (5, 5, 100.0, "passed")
    assert not any("_staging" in p for p in visible(tmp_path))


@pytest.mark.parametrize("broken, message", [
    (("size_us", "-1.0D"), "size_us"), (("sale_id", "1L"), "unique"), (("retail_price", "'x'"), "retail_price"),
])
def test_a_refused_run_shows_nothing_but_its_failures(spark, tmp_path, broken, message):
    store, run_date = Store(str(tmp_path)), "2025-01-01"
    store.write(spark.range(5), "raw", "sales", run_date)
    with pytest.raises(ContractViolation, match=message):
        run_validation(store, spark, run_date, SPEC, clean(spark).withColumn(broken[0], F.expr(broken[1])))
    assert {p.split("/")[0] for p in visible(tmp_path)} == {"raw", "failures"}
    rows = store.read(spark, "failures", "feature_violations", run_date)
    assert rows.count() == 5 and message.split("_")[0] in str(rows.first()["violations"])


def test_a_refused_run_may_be_kept_whole_outside_the_validated_zone(spark, tmp_path):
    store, run_date = Store(str(tmp_path)), "2025-01-01"
    store.write(spark.range(5), "raw", "sales", run_date)
    broken = clean(spark).withColumn("sale_price", F.when(F.col("sale_id") > 1, F.col("sale_price")).otherwise(0.0))
    with pytest.raises(ContractViolation, match="sale_price"):
        run_validation(store, spark, run_date, SPEC, broken, keep_refused=True)
    assert {p.split("/")[0] for p in visible(tmp_path)} == {"raw", "failures"}
    assert store.read(spark, "failures", "features", run_date).count() == 5


def test_too_few_rows_are_refused(spark, tmp_path):
    store = Store(str(tmp_path))
    store.write(spark.range(50), "raw", "sales", "2025-01-01")
    with pytest.raises(ContractViolation, match="kept 5 of 50"):
        run_validation(store, spark, "2025-01-01", SPEC, clean(spark))
    assert {p.split("/")[0] for p in visible(tmp_path)} == {"raw"}


def test_tables_land_together_or_not_at_all(spark, tmp_path):
    store = Store(str(tmp_path))
    rows, seen = counted(spark, spark.range(40).withColumnRenamed("id", "sale_id"))
    profile = {r["table"]: r["rows"] for r in land(store, {"a": rows, "b": spark.range(3)}, "raw", "r1").collect()}
    assert profile == {"a": 40, "b": 3} and seen.value == 40
    before = visible(tmp_path)
    with pytest.raises(ValueError, match="b"):
        land(store, {"a": rows.limit(7), "b": spark.range(0)}, "raw", "r1")
    wrong = spark.range(3).select(F.raise_error(F.lit("broken source")).alias("x"))
    with pytest.raises(Exception, match="broken source"):
        land(store, {"a": rows.limit(7), "b": wrong}, "raw", "r1")
    assert visible(tmp_path) == before and store.read(spark, "raw", "a", "r1").count() == 40


def test_an_update_replaces_its_partitions_only(spark, tmp_path):
    store, keys = Store(str(tmp_path)), ["run_date", "brand"]
    rows = spark.range(60).select("id", F.concat(F.lit("r"), F.col("id") % 3).alias("run_date"), F.concat(F.lit("0"), F.col("id") % 2).alias("brand"))
    store.update(rows, "features", "features", keys)
    files = {p: os.path.getmtime(p) for p in map(str, pathlib.Path(tmp_path).rglob("part-*"))}
    store.update(rows.where("run_date = 'r1' AND brand = '01'").limit(1), "features", "features", keys)
    table = store.table(spark, "features", "features")
    counts = {(r["run_date"], r["brand"]): r["n"] for r in table.groupBy("run_date", "brand").agg(F.count("*").alias("n")).collect()}
    assert counts == {(f"r{i}", f"0{j}"): 1 if (i, j) == (1, 1) else 10 for i in range(3) for j in range(2)}
    kept = [p for p in files if "run_date=r1/brand=01" not in p]
    assert all(os.path.getmtime(p) == files[p] for p in kept) and len(kept) == len(files) * 5 // 6
    with pytest.raises(ValueError):
        store.update(rows, "features", "features", ["brand"])


def test_runs_and_keys_are_pruned(spark, tmp_path):
    store = Store(str(tmp_path))
    rows = spark.range(600).select("id", F.concat(F.lit("r"), F.col("id") % 6).alias("run_date"), F.concat(F.lit("b"), F.col("id") % 5).alias("brand"))
    store.update(rows, "features", "features", ["run_date", "brand"])
    spark.createDataFrame([("b1", 1), ("b2", 2), ("b3", 3)], "brand STRING, place INT").write.parquet(f"{tmp_path}/asked")
    chosen = of_runs(store.table(spark, "features", "features"), "r4", spark.read.parquet(f"{tmp_path}/asked").where("place < 3"), "brand")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line and "run_date" in line)
    assert "run_date" in filters.split("PartitionFilters")[1] and "dynamicpruning" in filters.split("PartitionFilters")[1]
    assert chosen.count() == 80


def test_numbering(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009 - 500).alias("k"), F.lit("kept").alias("other")).repartition(7)
    got = sequential_id(rows, "k", "n").orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(1, 1001)) and got[0]["other"] == "kept"
    by_two = numbered(rows.withColumn("g", F.col("k") % 3), [F.col("g").desc(), F.col("k")], "n").orderBy("n").collect()
    assert [(r["g"], r["k"]) for r in by_two] == sorted(((r["g"], r["k"]) for r in by_two), key=lambda x: (-x[0], x[1]))
    assert sequential_id(rows.where("false"), "k", "n").count() == 0
