"""Column functions against plain Python."""

from __future__ import annotations

import datetime as dt
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from premia.functions.dates import canonical_date, days_between, elapsed_days
from premia.functions.prices import (
    first_non_empty,
    nan_to_null,
    ordinal_encode,
    positive_price,
    price_premium,
    round_exact,
)
from premia.functions.skus import normalize_sku, sku_candidates, stable_id
from premia.functions.text import brands_conflict, classify_release

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def evaluate(spark, values, kind, expression):
    """The expression over a one-column frame ``x``, in input order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    out = rows.select("i", expression(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(out, key=lambda r: r["i"])]


def test_codes_written_differently_become_one(spark):
    given_codes = ["DD1391-100", "DD1391 100", "cp9654", "  555088_101  ", "", None, "a-.-b", "--x//y--"]
    assert evaluate(spark, given_codes, "STRING", normalize_sku) == [
        "DD1391-100", "DD1391-100", "CP9654", "555088-101", "", "", "A-B", "X-Y",
    ]


def test_compound_codes_give_whole_then_parts(spark):
    assert evaluate(spark, ["BZ0057/B75806", "DD1391-100", "a/A/b", "", None, "/"], "STRING", sku_candidates) == [
        ["BZ0057-B75806", "BZ0057", "B75806"], ["DD1391-100"], ["A-A-B", "A", "B"], [], [], [],
    ]


def by_rule(raw):
    """The folding rule, character by character."""
    out = ""
    for ch in raw.upper():
        if ch in " -_/":
            out += "" if out.endswith("-") else "-"
        elif ch.isalnum():
            out += ch
    return out.strip("-")


@QUICK
@given(st.lists(st.text(alphabet="aB9 -_/.#é²\t", max_size=12), min_size=1, max_size=40))
def test_folding_follows_the_rule(spark, codes):
    assert evaluate(spark, codes, "STRING", normalize_sku) == [by_rule(c) for c in codes]


def test_ids_are_31_bit_checksums(spark):
    codes = ["DD1391-100", "CP9654", "ÉTÉ-1", ""]
    expected = [zlib.crc32(c.encode()) & 0x7FFFFFFF for c in codes]
    assert evaluate(spark, codes, "STRING", stable_id) == expected


def test_titles_fall_into_three_classes(spark):
    titles = ["Off-White x Air Jordan 1", "Yeezy Boost 350 V2 Zebra", "Nike Dunk Low Panda", "x", None,
              "KAWS limited", "Jordan 1 Retro High OG"]
    assert evaluate(spark, titles, "STRING", classify_release) == [
        "collab", "limited", "general", "collab", "general", "collab", "limited",
    ]


def test_brands_conflict_only_if_both_are_given(spark):
    rows = spark.createDataFrame(
        [("Nike", " nike\t", False), ("Nike", "Jordan", True), ("", "Jordan", False), ("Nike", None, False)],
        "a STRING, b STRING, expected BOOLEAN",
    )
    assert rows.where(brands_conflict(F.col("a"), F.col("b")) != F.col("expected")).isEmpty()


def test_dates_become_utc_midnights(spark):
    texts = ["2021-03-10T23:59:59.999Z", "2018-05-09", "2021", "2021-03-10T23:00:00-05:00", "soon", None]
    days = [(2021, 3, 10), (2018, 5, 9), (2021, 1, 1), (2021, 3, 11), None, None]
    expected = [d and dt.datetime(*d) for d in days]
    assert evaluate(spark, texts, "STRING", canonical_date) == expected
    with pytest.raises(Exception, match="not a date: soon"):
        evaluate(spark, texts, "STRING", lambda x: canonical_date(x, invalid="raise"))


def test_calendar_days_and_elapsed_days_differ(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 1, 23)),
         (dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1)),
         (dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 1))],
        "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ",
    )
    got = rows.select(days_between(F.col("a"), F.col("b")), elapsed_days(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1, 0), (-1, -1), (2, 2)]


def test_prices(spark):
    texts = ["120.5", "0", "-3", "n/a", "", "NaN", None, "inf"]
    assert evaluate(spark, texts, "STRING", positive_price) == [
        120.5, None, None, None, None, None, None, float("inf"),
    ]
    assert evaluate(spark, [220.0, 55.0, None], "DOUBLE", lambda x: price_premium(x, F.lit(110.0))) == [
        1.0, -0.5, None,
    ]
    assert evaluate(spark, [1.0], "DOUBLE", lambda x: price_premium(x, F.lit(0.0))) == [None]
    assert evaluate(spark, [float("nan"), 1.0, None], "DOUBLE", nan_to_null) == [None, 1.0, None]


def test_unmapped_categories_are_null_or_an_error(spark):
    ranks = {"limited": 2, "general": 0}
    assert evaluate(spark, ["limited", "raffle", None], "STRING", lambda x: ordinal_encode(x, ranks)) == [2, None, None]
    with pytest.raises(Exception, match="unmapped category: raffle"):
        evaluate(spark, ["limited", "raffle"], "STRING", lambda x: ordinal_encode(x, ranks, "raise"))


def test_empty_text_counts_as_missing(spark):
    rows = spark.createDataFrame([("", None, "c"), (None, "b", "c"), ("", "", None)], "a STRING, b STRING, c STRING")
    got = rows.select(first_non_empty(F.col("a"), F.col("b"), F.col("c")).alias("y")).collect()
    assert [r["y"] for r in got] == ["c", "b", ""]


@QUICK
@given(st.lists(st.one_of(
    st.floats(-1e6, 1e6, allow_nan=False),
    st.integers(-10**7, 10**7).map(lambda n: n / 1000),
    st.integers(-10**6, 10**6).map(lambda n: n / 8),
), min_size=1, max_size=200))
def test_rounding_equals_python(spark, values):
    for places in (2, 4):
        got = evaluate(spark, values, "DOUBLE", lambda x: round_exact(x, places))
        assert got == [round(v, places) for v in values]
