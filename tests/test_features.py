from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.values import family_label, finite_or_null, finite_or_zero, safe_key, week_label
from shelfcast.operators import features as ft
from tests.conftest import column


def test_safe_key(spark):
    names = ["LIQUOR,WINE,BEER", "HOME AND KITCHEN I", "BREAD/BAKERY", " a--b__c. ", "EGGS"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(safe_key(F.col("n"))).collect()]
    assert got == ["LIQUOR_WINE_BEER", "HOME_AND_KITCHEN_I", "BREAD_BAKERY", "A_B_C", "EGGS"]


def test_labels_and_numbers(spark):
    df = spark.createDataFrame([("EGGS", float("nan")), ("NEW", float("inf")), (None, None), ("DELI", 2.0)], "f string, x double")
    assert [r[0] for r in df.select(family_label(F.col("f"))).collect()] == ["蛋类", "NEW", None, "熟食"]
    assert [r[0] for r in df.select(finite_or_null(F.col("x"))).collect()] == [None, None, None, 2.0]
    assert [r[0] for r in df.select(finite_or_zero(F.col("x"))).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_week_labels_of_all_sundays(spark):
    days = [dt.date(2000, 1, 2) + dt.timedelta(days=7 * i) for i in range(1600)]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d date").select(week_label(F.col("d"))).collect()]
    assert got == [d.strftime("%Y-W%W") for d in days]


def test_calendar_parts(panel):
    r = ft.calendar_parts(panel([("2020-02-29", 1, "A", 1)])).first()
    assert (r["year"], r["month"], r["day"], r["weekday"], r["is_weekend"], r["week_of_year"], r["quarter"], r["days_to_monthend"]) == (2020, 2, 29, 5, 1, 9, 1, 0)


def test_lags_and_means_follow_dates_not_input_order(spark, one):
    df = one([float(i) for i in range(40)]).orderBy(F.rand(1))
    got = ft.rolling_means(ft.lags(df)).orderBy("date").collect()
    assert got[6]["sales_lag7"] is None and got[7]["sales_lag7"] == 0.0 and got[39]["sales_lag30"] == 9.0
    assert got[0]["sales_rolling7_mean"] == 0.0 and got[39]["sales_rolling7_mean"] == 36.0 and got[39]["sales_rolling30_mean"] == 24.5


@pytest.mark.parametrize("n", [30, 90, 101, 137])
def test_both_splits_round_in_doubles(one, n):
    df = one([1.0] * n)
    sizes = lambda d: {r["split"]: r["count"] for r in d.groupBy("split").count().collect()}
    a, b, end = int(n * 0.7), int(n * 0.15), int(n * (0.7 + 0.15))
    assert sizes(ft.split_chrono(df)) == {"train": a, "val": b, "test": n - a - b}
    assert sizes(ft.split_forecast(df)) == {"train": a, "val": end - a, "test": n - end}


def test_split_keeps_time_order(one):
    rows = ft.split_chrono(one([1.0] * 50)).orderBy("date").collect()
    assert [r["split"] for r in rows] == sorted((r["split"] for r in rows), key=["train", "val", "test"].index)


def test_scaling_is_fitted_on_train_only(one):
    df = ft.split_chrono(one([1.0, 2.0, 3.0] * 3 + [1.0] * 5 + [4.0, 5.0, 6.0, 7.0, 8.0, 9.0]))
    got = column(ft.minmax_train(df), "scaled")
    assert got[:3] == [0.0, 0.5, 1.0] and got[-1] == 4.0
    constant = ft.minmax_train(ft.split_chrono(one([5.0] * 10)))
    assert column(constant, "scaled") == [0.0] * 10
    back = ft.minmax_train(df).select("date", (ft.minmax_inverse(F.col("scaled")) - F.col("sales")).alias("gap"))
    assert max(abs(g) for g in column(back, "gap")) < 1e-12


def test_sliding_windows_shape(one):
    got = ft.sliding_windows(one([float(i) for i in range(100)])).orderBy("date").collect()
    assert len(got) == 70 and got[0]["window"] == [float(i) for i in range(30)] and got[0]["label"] == 30.0


def test_regressor_alignment_and_plan(panel, one):
    df = panel([(i, 1, "A", 1, 9) for i in range(3)])
    assert column(ft.align_regressor(df, df.filter("date = '2020-01-02'")), "onpromotion") == [0, 9, 0]
    spine = ft.future_dates(df, 4)
    assert column(spine, "step") == [1, 2, 3, 4] and str(column(spine, "date")[0]) == "2020-01-04"
    plan = df.select("family", "store_nbr", F.dayofmonth("date").alias("step"), "onpromotion")
    assert column(ft.future_regressor(spine, plan), "onpromotion") == [9, 9, 9, 0]


def test_holiday_windows(spark):
    rows = [("2020-05-01", "Holiday", "May", False), ("2020-06-01", "Event", "Fair", False), ("2020-07-01", "Holiday", "Moved", True), ("2020-08-01", "Bridge", "B", False)]
    cal = spark.createDataFrame([(dt.date.fromisoformat(d), t, "N", n, m) for d, t, n, m in rows], "date date, type string, locale string, description string, transferred boolean")
    got = sorted((r["holiday"], str(r["date"])) for r in ft.holiday_windows(cal).collect())
    assert got == [("Fair", "2020-06-01"), ("May", "2020-04-30"), ("May", "2020-05-01"), ("May", "2020-05-02")]


def test_difference_and_floor(one, spark):
    got = column(ft.difference(one([1.0, 4.0, 9.0, 16.0]), 2), "diff")
    assert got == [None, None, 2.0, 2.0]
    df = spark.createDataFrame([(0.0,), (2.0,), (None,)], "y double").select(ft.floor_zero(F.col("y")))
    assert [r[0] for r in df.collect()] == [0.01, 2.0, None]
