"""Wrong input raises, is refused or is counted; it never passes in silence."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from premia.functions.prices import round_exact
from premia.operators.contract import above, at_least, coerce, in_range, not_null
from premia.operators.models import RECORD_REQUIRED, record_is_valid
from premia.operators.ordering import sequential_id
from premia.operators.registry import promotion_decisions
from premia.plans.landing import with_exclusion
from premia.sources.market import read_prices, read_reference
from premia.sources.readers import scan_json

NAN = float("nan")


def feed(folder, **documents):
    folder.mkdir()
    for name, text in documents.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


@pytest.mark.parametrize("text", ['[{"a": 1}', '{"rows": [{"a": 1}]}', " ", "7", '{"data": [{"a": "x"}]}', '[{"a": 1.5}]', '[{"b": "$120"}]'])
def test_broken_documents_fail(spark, tmp_path, text):
    path = feed(tmp_path / "f", good='[{"a": 1}]', bad=text)
    with pytest.raises(Exception):
        scan_json(spark, path, "a LONG, b DOUBLE").collect()


def test_files_lists_envelopes_and_whole_numbers(spark, tmp_path):
    path = feed(tmp_path / "f", a='[{"sku": "x", "weekly_orders": 12.0}, {"sku": "y"}]', b='{"data": [{"sku": "z", "weekly_orders": 3}]}')
    rows = read_prices(spark, path).orderBy("ordinal").select("sku", "weekly_orders", "ordinal").collect()
    assert [(r.sku, r.weekly_orders) for r in rows] == [("x", 12), ("y", None), ("z", 3)]
    assert rows[2].ordinal - rows[0].ordinal == 2**32


@pytest.mark.parametrize("price", [None, 0, -5])
def test_reference_without_price_fails(spark, tmp_path, price):
    path = feed(tmp_path / "f", a=json.dumps([{"sku": "x", "retail_price": price}]))
    with pytest.raises(Exception):
        read_reference(spark, path).collect()


def test_reference_without_price_is_no_reference(spark):
    rows = spark.sql(
        "SELECT named_struct('retail_price', CAST(NULL AS DOUBLE), 'brand', 'b', 'release_date', '2021-01-01') AS ref,"
        " 'b' AS brand, 1.0D AS market_avg, '2021-01-01' AS release_date"
    )
    assert with_exclusion(rows).first().excluded == "no_retail"


def test_round_exact_leaves_what_has_no_places(spark):
    values = [NAN, float("inf"), -float("inf"), 1e16, 1e300, -1e300, 2.675, 0.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v DOUBLE").select(round_exact(F.col("v"), 4)).collect()]
    assert str(got[0]) == "nan" and got[1:6] == values[1:6] and got[6:] == [round(2.675, 4), 0.5]


def test_nan_record_is_refused(spark):
    good = {c: 1.0 for c in RECORD_REQUIRED}
    rows = [tuple(good.values())] + [tuple((good | {c: NAN}).values()) for c in RECORD_REQUIRED]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in RECORD_REQUIRED))
    assert [r[0] for r in frame.select(record_is_valid()).collect()] == [True] + [False] * len(RECORD_REQUIRED)


def test_nan_breaks_every_check(spark):
    frame = spark.createDataFrame([(NAN, "NaN")], "v DOUBLE, s STRING")
    checks = [not_null("v"), above("v", 0), at_least("v", -90), in_range("v", -1, 50)]
    assert all(frame.select(*(c.broken.alias(f"c{i}") for i, c in enumerate(checks))).first())
    assert not frame.select(not_null("s").broken).first()[0]
    assert coerce(frame, {"v": "double"}).first().v is None


@pytest.mark.parametrize("metric", [None, NAN])
def test_candidate_without_metric_fails(spark, metric):
    candidates = spark.createDataFrame([("m", metric)], "model STRING, rmse DOUBLE")
    empty = spark.createDataFrame([], "model STRING, rmse DOUBLE")
    versions = spark.createDataFrame([], "model STRING, last_version LONG")
    with pytest.raises(Exception):
        promotion_decisions(candidates, empty, "model", "rmse", versions).collect()


def test_numbers_with_far_ordinals(spark):
    ordinals = [5, -(2**60), 2**61, 0, 2**32 * 7, 2**32 * 9 + 3]
    rows = sequential_id(spark.createDataFrame([(o,) for o in ordinals], "o LONG"), "o", "id").collect()
    assert {r.o: r.id for r in rows} == {o: i + 1 for i, o in enumerate(sorted(ordinals))}
