"""Registered queries against their oracle SQL on the smallest data set."""

from __future__ import annotations

import pytest
from check_queries import TABLES, compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import entry
from premia.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, small, name):
    outcome, _, _ = compare(spark, connection, small, name)
    assert outcome == "ok"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_the_feature_columns(spark):
    assert entry(spark).columns[:3] == ["sale_id", "shoe_id", "brand"]


def test_validated_output_has_all_rows_of_a_refused_run(spark, small, tmp_path):
    for table in set(TABLES) - {"events"}:
        (tmp_path / f"{table}.parquet").symlink_to(f"{small}/{table}.parquet")
    events = spark.read.parquet(f"{small}/events.parquet")
    free = events.withColumn("value", F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value")))
    free.coalesce(1).write.parquet(f"{tmp_path}/events")
    written = next((tmp_path / "events").glob("part-*"))
    (tmp_path / "events.parquet").symlink_to(written)
    with pytest.warns(UserWarning, match="sale_price"):
        outcome, _, _ = compare(spark, duck(str(tmp_path)), str(tmp_path), "validated_output")
    assert outcome == "ok"


def test_not_null_counts_every_required_column(spark, small):
    counts = {r["check"]: r["n"] for r in QUERIES["check_not_null"](spark, small).collect()}
    assert len(counts) == 14 and min(counts.values()) > 0


def test_feed_files_have_a_bounded_size(spark, small, monkeypatch):
    from premia.catalog import landing

    paths, read = [], landing.scan_json
    monkeypatch.setattr(landing, "FEED_RECORDS", 10)
    monkeypatch.setattr(landing, "scan_json", lambda s, path, *a: paths.append(path) or read(s, path, *a))
    rows = sorted((r["p_partkey"], r["place"]) for r in QUERIES["scan_json_files"](spark, small).collect())
    assert [place for _, place in rows] == list(range(len(rows))) and len(rows) == spark.read.parquet(f"{small}/part.parquet").count() > 80
    records = [r[0].count("p_partkey") for r in spark.read.text(paths[0]).select("value").collect()]
    assert sum(records) == len(rows) and max(records) == 10
