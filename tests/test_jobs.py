"""Two run dates from feeds to promotion, drift and the board, without glue."""

from __future__ import annotations

import json

import pytest
from test_plans import raw_tables

from premia.plans.jobs import (
    append_history,
    promoted_version,
    record_run,
    run_board,
    run_features,
    run_monitoring,
    run_registration,
    run_snapshot,
)
from premia.plans.landing import land_tables
from premia.plans.training import TrainingRun, train_linear
from premia.plans.validation import run_validation
from premia.sources.writers import Store
from premia.spec import FeatureSpec


def test_two_run_dates(spark, tmp_path):
    store, spec = Store(str(tmp_path)), FeatureSpec()
    assert promoted_version(store, spark, "premium") is None
    for n, (run_date, shift) in enumerate((("2025-01-01", 0.0), ("2025-02-01", 400.0))):
        tables = raw_tables(spark, n=400, shift=shift)
        tables["sales"] = tables["sales"].where("shoe_id < 3 AND size_us IS NOT NULL")
        land_tables(store, tables, run_date)
        report = run_features(store, spark, run_date, spec)
        assert report["rows_in"] == report["rows_out"] > 100
        run_validation(store, spark, run_date, spec)
        assert run_monitoring(store, spark, run_date, "premium", features=["rolling_7d_avg_premium", "retail_price"])
        if n:
            counts = store.read(spark, "drift", "drift_features", run_date).select("n_reference", "n_current", "reference_run_date").first()
            assert counts["n_reference"] > 100 and counts["n_current"] == report["rows_out"] and counts["reference_run_date"] == "2025-01-01"
        run = train_linear(store.read(spark, "validated", "features", run_date), 2023)
        record_run(store, spark, run, run_date, f"run-{n}", "premium")
        worse = TrainingRun(run.model, run.val_rmse + 1, run.n_train, run.n_validation, [])
        record_run(store, spark, worse, run_date, f"worse-{n}", "premium")
        decision = run_registration(store, spark, run_date, "premium")
        assert (decision["run_id"], decision["version"]) == (f"run-{n}", n + 1)
        assert run_registration(store, spark, run_date, "premium") == decision
        if not n:
            assert decision["promoted"] and decision["beat_metric"] is None
            first = run.val_rmse
        else:
            assert decision["beat_metric"] == first and decision["promoted"] == (run.val_rmse < first)
    held = promoted_version(store, spark, "premium")
    assert held["run_date"] == ("2025-02-01" if decision["promoted"] else "2025-01-01")
    with pytest.raises(LookupError):
        run_registration(store, spark, "2025-03-01", "premium")


def test_history_is_capped_and_repeatable(spark, tmp_path):
    store = Store(str(tmp_path))
    for day in ("2025-01-01", "2025-01-02", "2025-01-02", "2025-01-03"):
        point = spark.createDataFrame([(1, 0.5)], "n INT, model_premium DOUBLE")
        rows = append_history(store, spark, day, point, cap=2)
    assert sorted(r["ts"] for r in rows.collect()) == ["2025-01-02", "2025-01-03"]


def test_history_query_appends_every_month(spark, tmp_path):
    from premia.catalog import QUERIES

    days = ["1996-11-03", "1997-01-05", "1997-01-09", "1997-12-31", "1998-02-01", "1998-03-01", "1998-04-01", "1998-08-02"]
    orders = spark.createDataFrame([(d, 100.0 + n) for n, d in enumerate(days)], "day STRING, o_totalprice DOUBLE")
    orders.selectExpr("CAST(day AS TIMESTAMP_NTZ) AS o_orderdate", "o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    rows = QUERIES["history_append"](spark, str(tmp_path)).collect()
    assert sorted(r["ts"] for r in rows) == ["1997-12", "1998-02", "1998-03", "1998-04", "1998-08"]


def test_board_writes_report_and_point(spark, tmp_path):
    store = Store(str(tmp_path))
    scored = spark.createDataFrame(
        [(1, "Nike", "A", "red", 100.0, 120.0, 0.3, 130.0), (2, "Nike", "B", None, 100.0, 150.0, 0.1, 110.0)],
        "shoe_id LONG, brand STRING, model STRING, colorway STRING, retail_price DOUBLE, sale_price DOUBLE, predicted_premium DOUBLE, implied_resale DOUBLE",
    )
    missing = spark.createDataFrame([("X-1",)], "sku STRING")
    history = run_board(store, spark, "2025-01-01", scored, missing).first()
    assert (history["n"], history["model_premium"], history["market_premium"]) == (2, 0.2, 0.35)
    report = spark.read.json(store.run_path("predictions", "board_report", "2025-01-01")).first()
    assert report["n_scored"] == 2 and report["n_uncomputable"] == 1


def test_board_keeps_all_uncomputable_codes(spark, tmp_path):
    store = Store(str(tmp_path))
    scored = spark.createDataFrame(
        [(1, "Nike", "A", "red", 100.0, 120.0, 0.3, 130.0)],
        "shoe_id LONG, brand STRING, model STRING, colorway STRING, retail_price DOUBLE, sale_price DOUBLE, predicted_premium DOUBLE, implied_resale DOUBLE",
    )

    def codes():
        return sorted(r["sku"] for r in store.read(spark, "predictions", "uncomputable", "2025-01-01").collect())

    def report():
        return json.loads(spark.read.text(store.run_path("predictions", "board_report", "2025-01-01")).first()[0])

    run_board(store, spark, "2025-01-01", scored, spark.range(2500).selectExpr("concat('X-', id) AS sku"))
    assert codes() == sorted(f"X-{n}" for n in range(2500))
    assert report()["n_uncomputable"] == 2500
    run_board(store, spark, "2025-01-01", scored)
    assert codes() == [] and report()["n_uncomputable"] == 0


def test_snapshot_job_verifies(spark, tmp_path):
    from test_plans import entry, price, snapshot  # noqa: F401
    from premia.sources.market import read_prices, read_reference, read_releases
    import json

    def feed(name, rows):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(json.dumps(rows))
        return str(tmp_path / name)

    prices = feed("p", [price("A1", 110.0)])
    releases = feed("r", [{"sku": "A1", "release_date": "2020-01-01T00:00:00Z"}])
    reference = feed("t", [entry("A1", 100.0)])
    store = Store(str(tmp_path / "store"))
    frames = read_prices(spark, prices), read_releases(spark, releases), read_reference(spark, reference)
    profile = run_snapshot(store, *frames, "2025-01-01")
    assert {r["table"]: r["rows"] for r in profile.collect()}["sales"] == 1
    with pytest.raises(ValueError):
        run_snapshot(store, frames[0].where("false"), *frames[1:], "2025-01-02")
