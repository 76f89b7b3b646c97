from __future__ import annotations

import pytest

from shelfcast.operators import validate as va

COLS = ["date", "store_nbr", "family", "sales", "onpromotion"]


def text(spark, rows, cols=COLS):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def report(df):
    return {(r["level"], r["code"]): r["n"] for r in va.validation_report(df).collect()}


def days(n, **kw):
    return [(f"2020-{1 + i // 28:02d}-{1 + i % 28:02d}", "1", "A", kw.get("sales", "5"), kw.get("promo", "0")) for i in range(n)]


def test_missing_column_stops_the_report(spark):
    df = text(spark, [("2020-01-01", "1", "A")], ["date", "store_nbr", "family"])
    assert report(df) == {("error", "missing_column:sales"): 1}
    with pytest.raises(ValueError, match="missing_column:sales"):
        va.require_valid(df)


def test_one_bad_date_is_an_error_and_hides_the_rest(spark):
    assert report(text(spark, days(10) + [("31/31/2020", "1", "A", "-4", "0")])) == {("error", "bad_date"): 1}


def test_empty_dates_are_no_error(spark):
    assert ("error", "bad_date") not in report(text(spark, days(100) + [(None, "1", "A", "4", "0"), ("", "1", "A", "4", "0")]))


def test_one_numeric_sales_value_is_enough(spark):
    rows = [("2020-01-01", "1", "A", "x", "0"), ("2020-01-02", "1", "A", "NaN", "0")]
    assert report(text(spark, rows)) == {("error", "no_numeric_sales"): 2}
    assert not any(level == "error" for level, _ in report(text(spark, rows + [("2020-01-03", "1", "A", "3", "0")])))


def test_warnings_and_stats(spark):
    rows = days(60) + [("2020-01-01", "1", "A", "-5", "-2")]
    assert report(text(spark, rows)) == {
        ("warning", "duplicate_rows"): 2, ("warning", "negative_sales"): 1, ("warning", "negative_promo"): 1, ("warning", "short_history"): 60,
        ("stat", "rows"): 61, ("stat", "days"): 60, ("stat", "null_cells"): 0, ("stat", "duplicate_rows"): 2,
    }
    va.require_valid(text(spark, rows))


def test_promotion_column_is_optional(spark):
    df = text(spark, [r[:4] for r in days(95)], COLS[:4])
    assert report(df) == {("stat", "rows"): 95, ("stat", "days"): 95, ("stat", "null_cells"): 0, ("stat", "duplicate_rows"): 0}


def test_duplicates_with_null_keys_are_equal(spark):
    df = text(spark, [(None, "1", "A", "1", "0")] * 3 + [("2020-01-01", "1", "A", "1", "0")])
    assert va.count_duplicates(df).first()["duplicate_rows"] == 3


def test_profile_names_families_and_stores(spark):
    df = text(spark, [("2020-01-01", "2", "B", "1", None), ("2020-01-03", "1", "A", "NaN", "0"), ("2020-01-03", "1", None, "2", "0")])
    rows = va.profile_raw(df).collect()
    stats = {r["stat"]: r["value"] for r in rows if r["stat"] not in ("family", "store")}
    assert stats == {"rows": "3", "start": "2020-01-01", "end": "2020-01-03", "days": "2", "null_cells": "3", "duplicate_rows": "0"}
    assert sorted(r["value"] for r in rows if r["stat"] == "family") == ["A", "B"]
    assert sorted(r["value"] for r in rows if r["stat"] == "store") == ["1", "2"]


def test_filter_series_defaults_keep_all(panel):
    df = panel([(0, 1, "A", 1), (0, 2, "A", 2), (0, 2, "B", 3)])
    assert va.filter_series(df).count() == 3
    assert va.filter_series(df, "A").count() == 2
    assert va.filter_series(df, None, 2).count() == 2
    assert va.filter_series(df, "B", 2).count() == 1


def test_options_carry_labels(panel):
    rows = {(r["kind"], r["value"], r["label"]) for r in va.options(panel([(0, 3, "EGGS", 1), (0, 3, "OTHER", 1)])).collect()}
    assert rows == {("family", "EGGS", "蛋类"), ("family", "OTHER", "OTHER"), ("store", "3", "3")}


def test_forecast_requests(spark, panel):
    df = panel([(i, 1, "A", 1) for i in range(40)] + [(i, 2, "A", 1) for i in range(5)])
    ok = ["ARIMA"]
    rows = [
        (1, "A", 1, 7, ok, "ok"), (2, "A", 1, 90, ["LSTM", "Prophet"], "ok"), (3, "A", 1, 200, ok, "horizon out of range"), (4, "A", 1, 6, ok, "horizon out of range"),
        (5, "Z", 1, 30, ok, "family unknown"), (6, "A", 9, 30, ok, "store unknown"), (7, "A", 2, 30, ok, "series too short"), (8, "A", 1, 30, [], "no model chosen"),
        (9, "A", 1, 30, ["Magic"], "model not supported"), (10, None, 1, 30, ok, "family missing"), (11, "A", 0, 30, ok, "store missing"), (12, "A", 1, 30, None, "no model chosen"),
    ]
    requests = spark.createDataFrame([r[:5] for r in rows], "request_id long, family string, store_nbr int, horizon int, models array<string>")
    got = {r["request_id"]: r["reason"] for r in va.forecast_request_check(requests, df).collect()}
    assert got == {r[0]: r[5] for r in rows}
