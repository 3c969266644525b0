"""Whole plans on small frames."""

from __future__ import annotations

import datetime as dt
import json
import pathlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from premia.operators.contract import (
    FEATURE_TYPES,
    ContractViolation,
    coerce,
    feature_checks,
    feature_violations,
    prepare_feature_checks,
    row_breaks,
    schema_issues,
    table_types,
    violating_rows,
)
from premia.operators.drift import drift_report
from premia.operators.models import fit_linear, scoring_report, split_records
from premia.operators.prep import fit_preprocessing
from premia.plans.features import feature_table
from premia.plans.landing import land_snapshot, land_tables
from premia.plans.monitoring import run_drift_check
from premia.plans.scoring import (
    run_scoring,
    score_batch,
    score_current,
    score_records,
    snapshot_features,
)
from premia.plans.training import load_model, save_model, train_linear
from premia.plans.validation import (
    require_retention,
    run_validation,
    validate_features,
    validated,
    validation_report,
)
from premia.sources.market import read_prices, read_reference, read_releases
from premia.sources.readers import scan_parquet, trim_fields
from premia.sources.warehouse import canonical_drop, canonical_tables
from premia.sources.writers import Store, landing_profile, require_rows, write_partitioned
from premia.spec import CANONICAL_SCHEMAS, FEATURE_TABLE_COLUMNS, MODEL_FEATURES, FeatureSpec
from premia.streaming.drift import store_baseline, stored_batches, stream_drift_counts, stream_drift_report
from premia.streaming.scoring import refused_records, scored_records, stream_outcomes

D = dt.datetime
SPEC = FeatureSpec()


# --- Feature table ------------------------------------------------------------------------------


def raw_tables(spark, seed=1, n=300, start=D(2022, 1, 1), shift=0.0):
    """Sales of four products, one of which has a third of them and one no brand."""
    rng = random.Random(seed)
    shoes = [
        (1, "Jordan", 180.0, D(2021, 12, 1), "limited"), (2, "Nike", 100.0, D(2021, 11, 1), "general"),
        (3, None, 120.0, D(2021, 10, 1), "raffle"), (4, "Nike", 0.0, D(2021, 12, 5), "collab"),
    ]
    sales = []
    for i in range(n):
        shoe = 1 if rng.random() < 1 / 3 else rng.choice([1, 2, 3, 4, 99])
        day = start + dt.timedelta(days=rng.randrange(500), hours=rng.choice([0, 13]))
        size = rng.choice([9.0, 9.5, 10.0, None])
        sales.append((i, shoe, "web", 100 + rng.randrange(200) + shift, day, size, "new", str(i)))
    drops = [(1, 1, D(2021, 12, 1), "limited", None), (2, 2, D(2021, 11, 1), "general", None),
             (3, 2, D(2021, 11, 4), "general", None)]
    search = [(s, d, "web", 10 * s + d.day) for s in (1, 2, 3) for d in
              (D(2021, 11, 1), D(2021, 11, 4), D(2021, 11, 23), D(2021, 11, 24), D(2021, 12, 1), D(2021, 12, 2))]
    return {
        "sales": spark.createDataFrame(sales, CANONICAL_SCHEMAS["sales"]),
        "shoes": spark.createDataFrame(
            [(i, b, "m", "c", r, d, t, "s") for i, b, r, d, t in shoes], CANONICAL_SCHEMAS["shoes"]
        ),
        "drops": spark.createDataFrame(drops, CANONICAL_SCHEMAS["drops"]),
        "search_interest": spark.createDataFrame(search, CANONICAL_SCHEMAS["search_interest"]),
    }


def features_of(tables, spec=SPEC):
    return feature_table(tables["sales"], tables["shoes"], tables["drops"], tables["search_interest"], spec)


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


@pytest.mark.parametrize("most, grain", [(0, "second"), (60, "second"), (10**6, "second"), (0, "day"), (60, "day"), (10**6, "day")])
def test_feature_table_does_not_depend_on_which_products_are_frequent(spark, most, grain):
    tables = raw_tables(spark)
    odd = F.when(F.col("sale_id") % 11 == 0, None).otherwise(F.col("sale_date"))
    day = F.date_trunc("day", odd).cast("timestamp_ntz") if grain == "day" else odd
    price = F.when(F.col("sale_id") % 7 == 0, None).otherwise(F.col("sale_price"))
    tables["sales"] = tables["sales"].withColumns({"sale_date": day, "sale_price": price})
    tables["shoes"] = tables["shoes"].unionByName(tables["shoes"].where("shoe_id < 3"))
    spec = FeatureSpec(sale_grain=grain, signal_grain=grain)

    def rows(most):
        features = feature_table(tables["sales"], tables["shoes"], tables["drops"], tables["search_interest"], spec, most)
        return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in features.collect()], key=repr)

    assert rows(most) == rows(10**6 if most < 10**6 else 0)


def test_sales_of_rare_products_are_not_shuffled_by_size(spark):
    tables = raw_tables(spark)
    plan = features_of(tables)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert dealt and not any("size_us#" in line for line in dealt)


def test_feature_table_equals_row_by_row_computation(spark):
    tables = raw_tables(spark)
    features = features_of(tables)
    assert features.columns == FEATURE_TABLE_COLUMNS
    got = features.collect()
    shoes = {r["shoe_id"]: r for r in tables["shoes"].collect()}
    sales = [r for r in tables["sales"].collect() if r["shoe_id"] in shoes]
    assert len(got) == len(sales)

    def premium(sale):
        retail = shoes[sale["shoe_id"]]["retail_price"]
        return (sale["sale_price"] - retail) / retail if retail else None

    by_id = {s["sale_id"]: s for s in sales}
    demand = {1: mean([34.0, 11.0]), 2: mean([21.0, 21.0, 24.0])}
    for r in got:
        sale, shoe = by_id[r["sale_id"]], shoes[r["shoe_id"]]
        mine = [s for s in sales if s["shoe_id"] == r["shoe_id"]]
        week = [premium(s) for s in mine if sale["sale_date"] - dt.timedelta(days=7) <= s["sale_date"] <= sale["sale_date"]]
        history = (sale["sale_date"].date() - min(s["sale_date"] for s in mine).date()).days
        rolling = mean(week) if history >= 7 else None
        base = mean(premium(s) for s in mine)
        sized = mean(premium(s) for s in mine if s["size_us"] == sale["size_us"])
        brand = mean(premium(s) for s in sales if shoes[s["shoe_id"]]["brand"] == shoe["brand"])
        expected = {
            "price_premium": premium(sale),
            "days_since_release": (sale["sale_date"].date() - shoe["release_date"].date()).days,
            "release_type_encoded": {"limited": 2, "collab": 1, "general": 0}.get(shoe["release_type"]),
            "rolling_7d_avg_premium": rolling,
            "size_premium": None if base is None else sized - base,
            "brand_avg_premium": brand if shoe["brand"] else None,
            "search_index_7d_pre_drop": demand.get(r["shoe_id"]),
        }
        for name, value in expected.items():
            assert r[name] == (None if value is None else pytest.approx(value, abs=1e-9)), name


def test_repeated_products_fan_out(spark):
    tables = raw_tables(spark, n=50)
    tables["shoes"] = tables["shoes"].union(tables["shoes"].where("shoe_id = 2"))
    twos = tables["sales"].where("shoe_id = 2").count()
    assert features_of(tables).where("shoe_id = 2").count() == 2 * twos


# --- Contract -----------------------------------------------------------------------------------


def clean(spark):
    rows = []
    for i, (shoe, brand, kind, rank, retail, day, rolling) in enumerate([
        (1, "Jordan", "limited", 2, 180.0, D(2022, 1, 1), None), (1, "Jordan", "limited", 2, 180.0, D(2022, 1, 4), None),
        (1, "Jordan", "limited", 2, 180.0, D(2022, 1, 12), 1.3), (2, "Nike", "general", 0, 100.0, D(2022, 3, 1), None),
        (2, "Nike", "general", 0, 100.0, D(2022, 3, 15), 0.1),
    ]):
        premium = 1.3 if shoe == 1 else 0.1
        release = D(2021, 12, 1) if shoe == 1 else D(2022, 2, 1)
        rows.append((i + 1, shoe, brand, 9.0 + i / 2, day, release, retail, retail * (1 + premium), kind, premium,
                     (day - release).days, 0.0, rank, rolling, 80.0, premium))
    ddl = ", ".join(f"{c} {FEATURE_TYPES[c].upper()}" for c in FEATURE_TABLE_COLUMNS)
    return spark.createDataFrame(rows, ddl)


MUTATIONS = {
    "days_since_release": ("sale_id = 1", "-95L", "days_since_release"),
    "price_premium": ("sale_id = 3", "99.0D", "price_premium"),
    "rolling_7d_avg_premium": ("sale_id = 1", "0.9D", "<row>"),
    "size_us": ("sale_id = 2", "0.0D", "size_us"),
    "sale_price": ("sale_id = 2", "-1.0D", "sale_price"),
    "release_type": ("sale_id = 2", "'raffle'", "release_type"),
    "release_type_encoded": ("sale_id = 2", "7L", "release_type_encoded"),
    "brand": ("sale_id = 4", "CAST(NULL AS STRING)", "brand"),
    "sale_id": ("sale_id = 2", "1L", "sale_id"),
}


def test_clean_features_pass(spark):
    assert validated(clean(spark)).count() == 5
    assert validate_features(clean(spark)).violations.isEmpty()


@pytest.mark.parametrize("column", MUTATIONS)
def test_each_broken_rule_is_found(spark, column):
    rows, value, reported = MUTATIONS[column]
    broken = clean(spark).withColumn(column, F.expr(f"CASE WHEN {rows} THEN {value} ELSE {column} END"))
    failures = validate_features(broken).failures.collect()
    assert [r["column"] or "<row>" for r in failures] == [reported]
    assert failures[0]["n"] == (2 if column == "sale_id" else 1)
    with pytest.raises(ContractViolation, match=reported):
        validated(broken)


def test_all_failures_are_listed_and_rows_named(spark):
    broken = clean(spark).withColumns({
        "size_us": F.when(F.col("sale_id") == 1, -1.0).otherwise(F.col("size_us")),
        "price_premium": F.when(F.col("sale_id") < 3, 99.0).otherwise(F.col("price_premium")),
    })
    with pytest.raises(ContractViolation) as error:
        validated(broken)
    assert "size_us" in str(error.value) and "price_premium" in str(error.value)
    rows = {r["sale_id"]: r["violations"] for r in validate_features(broken).violations.collect()}
    assert rows == {1: ["size_us:> 0", "price_premium:in [-1, 50]"], 2: ["price_premium:in [-1, 50]"]}


def test_checks_across_rows_get_narrow_rows_and_all_labels(spark):
    third = F.col("sale_id") % 3
    broken = clean(spark).withColumns(
        {"sale_id": F.when(third == 1, 0).otherwise(F.col("sale_id")).cast("long"), "sale_price": F.when(third == 0, -1.0),
         "size_us": F.lit(float("nan")), "release_type": F.lit("raffle"), "rolling_7d_avg_premium": F.lit(0.5)}
    )
    typed, columns = coerce(broken, FEATURE_TYPES), ["sale_id", "shoe_id", "sale_date"]
    breaks = row_breaks(typed, SPEC, columns)
    assert breaks.columns == [*columns, "rolling_7d_avg_premium", "_broken"]
    assert dict(breaks.dtypes)["rolling_7d_avg_premium"] == "boolean"
    wide = violating_rows(prepare_feature_checks(typed), feature_checks(SPEC), columns)
    rows = [sorted(map(repr, r.collect())) for r in (feature_violations(breaks, SPEC, columns), wide)]
    assert rows[0] == rows[1] and len(rows[0]) == 5 and "unique" in str(rows[0]) and "history" in str(rows[0])


def test_same_shoe_size_and_day_may_repeat(spark):
    again = clean(spark).where("sale_id = 1").withColumn("sale_id", F.lit(999).cast("long"))
    assert validated(clean(spark).union(again)).count() == 6


def test_columns_must_match_and_fit(spark):
    rows = clean(spark).withColumnRenamed("brand", "label").withColumn("size_us", F.lit("nine"))
    issues = {(r["column"], r["issue"], r["n"]) for r in schema_issues(rows, FEATURE_TYPES).collect()}
    assert issues == {("brand", "missing", None), ("label", "unexpected", None), ("size_us", "not coercible", 5)}
    with pytest.raises(ContractViolation, match="label"):
        validated(rows)
    narrow = clean(spark).withColumn("sale_id", F.col("sale_id").cast("int"))
    assert dict(validated(narrow).dtypes)["sale_id"] == "bigint"


def test_retention_has_a_floor(spark):
    sales = spark.range(100)
    assert require_retention(sales, spark.range(95)) == 95.0
    assert require_retention(sales, spark.range(120)) == 120.0
    with pytest.raises(ContractViolation, match="kept 5 of 100"):
        require_retention(sales, spark.range(5))
    report = validation_report(spark.range(5), clean(spark)).first()
    assert (report["row_retention_pct"], report["rolling_null_rows"]) == (100.0, 3)


# --- Landing ------------------------------------------------------------------------------------


def feed(path, records, envelope):
    path.mkdir()
    (path / "a.json").write_text(json.dumps({"data": records} if envelope else records))
    return str(path)


def snapshot(spark, tmp_path, prices, releases, reference, envelope=True):
    return land_snapshot(
        read_prices(spark, feed(tmp_path / "p", prices, envelope)),
        read_releases(spark, feed(tmp_path / "r", releases, envelope)),
        read_reference(spark, feed(tmp_path / "t", reference, False)),
        "2026-07-04",
    )


def price(sku, avg=120.0, brand="Nike", **more):
    return {"sku": sku, "avg_price": avg, "brand": brand, "id": f"id-{sku}", "title": f"{brand} shoe", **more}


def entry(sku, retail, kind="general", brand="Nike", **more):
    return {"sku": sku, "retail_price": retail, "release_type": kind, "brand": brand, **more}


@pytest.mark.parametrize("envelope", [True, False])
def test_compound_code_finds_its_parts(spark, tmp_path, envelope):
    landing = snapshot(
        spark, tmp_path, [price("BZ0057/B75806", brand="adidas", weekly_orders=4)],
        [{"sku": "B75806", "release_date": "2018-05-09T23:59:59.999Z", "colorway": "white"}],
        [entry("B75806", 100.0, brand="Adidas")], envelope,
    )
    landing.verify()
    for name, rows in landing.tables.items():
        assert [c for c, _ in rows.dtypes] == list(table_types(name))
        assert rows.dtypes == spark.createDataFrame([], CANONICAL_SCHEMAS[name]).dtypes
    shoe = landing.tables["shoes"].first()
    assert (shoe["retail_price"], shoe["release_date"], shoe["colorway"]) == (100.0, D(2018, 5, 9), "white")
    assert shoe["shoe_id"] == zlib.crc32(b"B75806") & 0x7FFFFFFF
    sale = landing.tables["sales"].first()
    assert (sale["sale_id"], sale["sale_price"], sale["size_us"], sale["condition"]) == (1, 120.0, 9.0, "new")
    assert (sale["sale_date"], sale["platform"]) == (D(2026, 7, 4), "StockX")
    assert landing.tables["drops"].first()["announced_at"] is None
    assert landing.tables["search_interest"].first()["search_index"] == 4


def test_exclusions_have_one_reason_each(spark, tmp_path):
    releases = [{"sku": s, "release_date": "2020-01-01T00:00:00Z"} for s in ("A1", "A_1", "B1", "C1", "F1")]
    releases += [{"sku": "E 1", "release_date": None, "release_date_year": "2019"},
                 {"sku": "D1", "release_date": "", "release_date_year": ""}, {"sku": "E1", "release_date_year": "2021"}]
    landing = snapshot(
        spark, tmp_path,
        [price("A1"), price("a1", 999.0), price("A 1"), price("X9"), price("B1", brand="Jordan"), price("C1", 0), price("D1"),
         price("E1", "n/a"), price("E-1"), price("F1", title="Off-White x Nike"), price("")],
        releases,
        [entry("A1", 50.0), entry("A-1", 60.0), entry("B1", 1.0), entry("C1", 1.0), entry("D1", 1.0),
         entry("E-1", 80.0), entry("E1", 70.0), entry("F1", 9.0, kind="")],
    )
    landing.verify()
    assert {r["reason"]: r["n"] for r in landing.exclusions.collect()} == {
        "no_retail": 1, "identity_mismatch": 1, "no_market": 2, "no_release_date": 1,
    }
    shoes = {r["retail_price"]: r for r in landing.tables["shoes"].collect()}
    assert set(shoes) == {50.0, 60.0, 80.0, 9.0}
    assert shoes[9.0]["release_type"] == "collab"
    assert shoes[80.0]["release_date"] == D(2019, 1, 1)
    prices = landing.tables["sales"].orderBy("sale_id").collect()
    assert [r["sale_id"] for r in prices] == [1, 2, 3, 4]
    assert [r["source_item_id"] for r in prices] == ["id-A1", "id-A 1", "id-E-1", "id-F1"]


def test_reference_date_fills_in_and_ids_must_differ(spark, tmp_path):
    landing = snapshot(
        spark, tmp_path, [price("B7"), price("Q/B7")], [], [entry("B7", 100.0, release_date="2018-05-09")]
    )
    assert landing.tables["shoes"].first()["release_date"] == D(2018, 5, 9)
    with pytest.raises(ValueError, match="share the id"):
        landing.verify()


def test_empty_landing_is_an_error(spark, tmp_path):
    landing = snapshot(spark, tmp_path, [price("U1")], [], [entry("D1", 1.0)])
    with pytest.raises(ValueError, match="'no_retail': 1"):
        landing.verify()


def test_warehouse_becomes_canonical(spark):
    sales = spark.createDataFrame(
        [(1, 10, "StockX", "220.50", dt.date(2022, 1, 1), "9.5", "new", "x")],
        "sale_key INT, shoe_key INT, source STRING, sold_price STRING, sold_date DATE, size STRING, "
        "condition STRING, source_item_id STRING",
    ).withColumn("sold_price", F.col("sold_price").cast("decimal(10,2)"))
    shoes = spark.createDataFrame(
        [(10, "Nike", "Dunk", "black", "low"), (11, "Nike", "No drop", "red", "low")],
        "shoe_key INT, brand STRING, model_name STRING, colorway STRING, silhouette STRING",
    )
    drops = spark.createDataFrame(
        [(5, 10, dt.date(2021, 5, 1), 110.0, "general"), (6, 10, dt.date(2021, 3, 1), 100.0, "limited")],
        "drop_key INT, shoe_key INT, release_date DATE, retail_price DOUBLE, release_type STRING",
    )
    search = spark.createDataFrame(
        [(10, dt.date(2021, 2, 27), "US", 55)], "shoe_key INT, point_date DATE, geo STRING, interest INT"
    )
    tables = canonical_tables(sales, shoes, drops, search)
    for name, rows in tables.items():
        assert rows.dtypes == spark.createDataFrame([], CANONICAL_SCHEMAS[name]).dtypes
    assert [(r["shoe_id"], r["retail_price"], r["release_type"]) for r in tables["shoes"].collect()] == [(10, 100.0, "limited")]
    assert tables["sales"].first()["sale_price"] == 220.5
    assert canonical_drop(drops, "shoe_key", "release_date", ["drop_key"]).first()["drop_key"] == 6


# --- Store, training, scoring, drift, streaming -------------------------------------------------


def test_store_keeps_runs_apart(spark, tmp_path):
    store = Store(str(tmp_path))
    rows = spark.createDataFrame([(1, "Nike"), (2, "Jordan"), (3, "007")], "id INT, brand STRING")
    store.write(rows, "features", "features", "2025-01-01", ["brand"])
    store.write(rows.where("id = 2"), "features", "features", "2025-01-02", ["brand"])
    assert sorted(r["id"] for r in store.read(spark, "features", "features", "2025-01-01").collect()) == [1, 2, 3]
    store.write(rows.where("brand = '007'"), "features", "features", "2025-01-01", ["brand"])
    rerun = store.read(spark, "features", "features", "2025-01-01").collect()
    assert [(r["id"], r["brand"]) for r in rerun] == [(3, "007")]  # no brand of the first attempt is left
    assert [r["id"] for r in store.read(spark, "features", "features", "2025-01-02").collect()] == [2]
    assert (tmp_path / "features" / "features" / "run_date=2025-01-02" / "brand=Jordan").is_dir()
    all_runs = spark.read.parquet(store.path("features", "features")).where("run_date = '2025-01-02'")
    assert "PartitionFilters: [isnotnull(run_date" in all_runs._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="unknown zone"):
        store.path("nowhere", "t")
    with pytest.raises(ValueError, match="empty tables: b"):
        require_rows({"a": rows, "b": rows.limit(0)})


def test_hot_partition_is_split_over_files(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 7 AS STRING) END AS k")
    path = str(tmp_path / "t")
    write_partitioned(rows, path, ["k"])
    assert spark.read.parquet(path).count() == 60_000


def test_missing_values_are_null_and_fields_are_trimmed(spark, tmp_path):
    rows = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "id INT, v DOUBLE")
    rows.write.parquet(str(tmp_path / "t"))
    back = scan_parquet(spark, str(tmp_path / "t"))
    assert {(r["id"], r["v"]) for r in back.collect()} == {(1, None), (2, 1.5)}
    assert trim_fields(back, ["v", "absent"]).columns == ["v"]


def labelled(spark, n=600, years=(2021, 2022, 2023)):
    """Rows whose premium is a linear function of two features."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1) for _ in MODEL_FEATURES]
        rows.append((i, i % 5, "b", D(rng.choice(years), 5, 1), *x, 2 * x[0] - x[2] + 0.5))
    doubles = ", ".join(f"{c} DOUBLE" for c in [*MODEL_FEATURES, "price_premium"])
    return spark.createDataFrame(rows, f"sale_id LONG, shoe_id LONG, brand STRING, sale_date TIMESTAMP_NTZ, {doubles}")


def test_linear_model_recovers_the_line(spark, tmp_path):
    rows = labelled(spark)
    run = train_linear(rows, 2023)
    assert run.val_rmse < 1e-9
    scored = score_batch(rows, run.model)
    assert scored.columns == ["sale_id", "shoe_id", "brand", "sale_date", "predicted_premium", "actual_premium"]
    assert scoring_report(scored).first().asDict() == {"n_scored": 600, "rmse_vs_actual": 0.0}
    unlabelled = score_batch(rows.drop("price_premium"), run.model)
    assert "actual_premium" not in unlabelled.columns
    path = save_model(Store(str(tmp_path)), spark, run, "2025-01-01", "run1")
    assert load_model(spark, path) == run.model


def records(spark):
    base = {c: 1.0 for c in MODEL_FEATURES}
    variants = [{}, {"rolling_7d_avg_premium": None, "search_index_7d_pre_drop": None}, {"size_us": 0.0},
                {"retail_price": -1.0}, {"brand_avg_premium": None}]
    rows = [(i, *({**base, **v}[c] for c in MODEL_FEATURES)) for i, v in enumerate(variants)]
    return spark.createDataFrame(rows, "id INT, " + ", ".join(f"{c} DOUBLE" for c in MODEL_FEATURES))


def test_records_are_scored_or_refused_in_batch_and_stream(spark, tmp_path):
    model = train_linear(labelled(spark), 2023).model
    scored, refused = score_records(records(spark), model)
    batch = {r["id"]: r["predicted_premium"] for r in scored.collect()}
    assert set(batch) == {0, 1} and {r["id"] for r in refused.collect()} == {2, 3, 4}
    with pytest.raises(ValueError, match="empty batch"):
        score_records(records(spark).limit(0), model)

    source = str(tmp_path / "in")
    records(spark).repartition(2).write.parquet(source)
    stream = spark.readStream.schema(records(spark).schema).parquet(source)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def outcomes():
        schema = records(spark).schema
        refused = {r["id"] for r in refused_records(spark, out, schema).collect()}
        return {r["id"]: r["predicted_premium"] for r in scored_records(spark, out, schema).collect()}, refused

    for _ in range(2):  # the second run finds nothing new
        stream_outcomes(stream, model, out, checkpoint).awaitTermination()
    assert outcomes() == (batch, {2, 3, 4})
    files = sorted(p.name for p in pathlib.Path(out).rglob("part-*"))
    # A batch that is repeated, since its commit was lost, replaces what it has written.
    for name in ("0", ".0.crc"):
        (pathlib.Path(checkpoint) / "commits" / name).unlink()
    stream_outcomes(stream, model, out, checkpoint).awaitTermination()
    assert outcomes() == (batch, {2, 3, 4}) and sorted(p.name for p in pathlib.Path(out).rglob("part-*")) != files
    # All good records: no refused folder, an empty table.
    good = str(tmp_path / "good")
    records(spark).where("id < 2").write.parquet(str(tmp_path / "in2"))
    stream_outcomes(spark.readStream.schema(records(spark).schema).parquet(str(tmp_path / "in2")), model, good, str(tmp_path / "c2")).awaitTermination()
    assert refused_records(spark, good, records(spark).schema).count() == 0


def test_stream_drift_adds_up_over_batches(spark, tmp_path):
    reference = spark.range(2000).selectExpr("CAST(id % 100 AS DOUBLE) AS a", "rand(1) AS b")
    reference.write.parquet(str(tmp_path / "ref"))
    reference = spark.read.parquet(str(tmp_path / "ref"))
    source = str(tmp_path / "in")
    baseline = str(tmp_path / "baseline")
    edges = store_baseline(reference, ["a", "b"], baseline)
    counts, checkpoint = str(tmp_path / "counts"), str(tmp_path / "c")
    for batch in range(3):
        spark.range(500).selectExpr(f"CAST((id % 50) + {batch * 20} AS DOUBLE) AS a", f"rand({batch}) AS b") \
            .write.mode("append").parquet(source)
        stream = spark.readStream.schema("a DOUBLE, b DOUBLE").parquet(source)
        stream_drift_counts(stream, edges, counts, checkpoint).awaitTermination()
    got = {r["feature"]: (r["psi"], r["drifted"]) for r in stream_drift_report(spark, ["a", "b"], counts, baseline).collect()}
    whole = {r["feature"]: (r["psi"], r["drifted"]) for r in drift_report(reference, spark.read.parquet(source), ["a", "b"]).collect()}
    assert got == {f: (pytest.approx(p), d) for f, (p, d) in whole.items()}


def test_stream_drift_reads_as_much_after_many_batches(spark, tmp_path):
    reference = spark.range(300).selectExpr("CAST(id % 50 AS DOUBLE) AS a")
    source, counts, baseline = (str(tmp_path / n) for n in ("in", "counts", "baseline"))
    edges = store_baseline(reference, ["a"], baseline)
    spark.range(1000).selectExpr("CAST(id % 70 AS DOUBLE) AS a").repartition(50).write.parquet(source)
    stream = spark.readStream.schema("a DOUBLE").option("maxFilesPerTrigger", 1).parquet(source)
    stream_drift_counts(stream, edges, counts, str(tmp_path / "c")).awaitTermination()
    assert stored_batches(spark, counts) == [48, 49]
    assert len(list(pathlib.Path(counts).rglob("part-*"))) == 2

    def psi():
        return stream_drift_report(spark, ["a"], counts, baseline).first()["psi"]

    whole = drift_report(reference, spark.read.parquet(source), ["a"]).first()["psi"]
    assert psi() == pytest.approx(whole)
    for name in ("49", ".49.crc"):
        (tmp_path / "c" / "commits" / name).unlink()
    stream_drift_counts(stream, edges, counts, str(tmp_path / "c")).awaitTermination()  # the last batch once more
    assert psi() == pytest.approx(whole)


def test_a_run_goes_through_every_zone(spark, tmp_path):
    store = Store(str(tmp_path))
    spec = FeatureSpec()
    for run_date, shift in (("2025-01-01", 0.0), ("2025-02-01", 400.0)):
        tables = raw_tables(spark, n=400, shift=shift)
        tables["sales"] = tables["sales"].where("shoe_id < 3 AND size_us IS NOT NULL")
        profile = {r["table"]: r["rows"] for r in land_tables(store, tables, run_date).collect()}
        assert profile["shoes"] == 4 and profile["sales"] > 100
        landed = {t: store.read(spark, "raw", t, run_date) for t in CANONICAL_SCHEMAS}
        store.write(features_of(landed, spec), "features", "features", run_date, ["brand"])
        run_validation(store, spark, run_date, spec)
        report = spark.read.json(store.run_path("validated", "validation_report", run_date)).first()
        assert report["row_retention_pct"] == 100.0 and report["status"] == "passed"
    run = train_linear(store.read(spark, "validated", "features", "2025-01-01"), 2023)
    run_scoring(store, spark, "2025-01-01", run.model)
    assert not store.read(spark, "predictions", "predictions", "2025-01-01").isEmpty()
    assert run_drift_check(store, spark, "2025-01-01", None)
    assert not run_drift_check(store, spark, "2025-01-01", "2025-01-01")
    assert run_drift_check(store, spark, "2025-02-01", "2025-01-01", features=["rolling_7d_avg_premium", "retail_price"])
    # sale dates do not move, so the check on them alone stays quiet
    assert not run_drift_check(store, spark, "2025-02-01", "2025-01-01", features=["days_since_release"])


def test_snapshot_is_scored_and_narrowed(spark, tmp_path):
    landing = snapshot(
        spark, tmp_path, [price("A1", 110.0), price("B2/C3", 300.0, brand="Jordan")],
        [{"sku": s, "release_date": "2020-01-01T00:00:00Z"} for s in ("A1", "C3")],
        [entry("A1", 100.0), entry("C3", 150.0, "limited", "Jordan")],
    )
    features = snapshot_features(landing.tables, SPEC.release_type_ranks).collect()
    assert {(r["brand"], round(r["brand_avg_premium"], 9), r["release_type_encoded"], r["size_premium"]) for r in features} == {
        ("Nike", 0.1, 0, 0.0), ("Jordan", 1.0, 2, 0.0)}
    assert all(r["rolling_7d_avg_premium"] is None for r in features)
    model = fit_linear(spark.createDataFrame([(100.0, 1.0), (200.0, 2.0)], "retail_price DOUBLE, y DOUBLE"), ["retail_price"], "y")
    reference = read_reference(spark, str(tmp_path / "t"))
    everything, missing = score_current(landing.tables, model, SPEC.release_type_ranks, reference)
    assert everything.count() == 2 and missing is None
    asked = spark.createDataFrame([(1, "b2/c3"), (2, "nope"), (3, "C-3")], "request_id INT, sku STRING")
    scored, missing = score_current(landing.tables, model, SPEC.release_type_ranks, reference, asked)
    row = scored.first()
    assert (row["brand"], scored.count()) == ("Jordan", 1)
    assert row["implied_resale"] == pytest.approx(150.0 * (1 + row["predicted_premium"]))
    assert {r["request_id"] for r in missing.collect()} == {2, 3}


def test_profile_names_types(spark):
    rows = spark.createDataFrame([(1, "a")], "id INT, s STRING")
    got = landing_profile({"t": rows}).first()
    assert (got["table"], got["column_count"], got["schema"], got["rows"]) == ("t", 2, "id:int, s:string", 1)
    assert coerce(rows, {"id": "long"}).dtypes == [("id", "bigint")]
    valid, refused = split_records(records(spark))
    assert valid.count() + refused.count() == 5
    assert fit_preprocessing(rows, ["id"]).std == [1.0]


def test_line_items_meet_orders_once(spark, small):
    """Release dates and demand read the stored drops: the feature table's own plan has no orders left."""
    from premia.catalog.features import item_features

    files = item_features(spark, small).inputFiles()
    assert any("lineitem" in f for f in files) and not any("orders.parquet" in f for f in files)
