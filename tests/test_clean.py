from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import clean as cl
from shelfcast.schema import PANEL_SCHEMA
from tests.conftest import column


def no_events(spark):
    return spark.createDataFrame([], "date date, type string, locale string, description string, transferred boolean")


def events(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), t, loc, "x", moved) for d, t, loc, moved in rows], "date date, type string, locale string, description string, transferred boolean")


def test_coerce_reads_formats_and_drops_nan(spark):
    rows = [("2020-01-02", "1", "A", "3.5", "2"), ("2020/1/3", "1", "A", "NaN", "x"), ("1/4/2020", "1", "A", "abc", None), ("20200105", "1", "A", " 7 ", "1"), ("soon", "x", "A", "1", "1")]
    got = cl.coerce_types(spark.createDataFrame(rows, "date string, store_nbr string, family string, sales string, onpromotion string")).collect()
    assert [str(r["date"]) for r in got] == ["2020-01-02", "2020-01-03", "2020-01-04", "2020-01-05", "None"]
    assert [r["sales"] for r in got] == [3.5, None, None, 7.0, 1.0]
    assert [r["onpromotion"] for r in got] == [2, 0, 0, 1, 1]
    assert got[4]["store_nbr"] is None


def test_merge_sums_and_turns_null_into_zero_unless_kept(panel):
    df = panel([(0, 1, "A", 2, 1), (0, 1, "A", 3, 1), (1, 1, "A", None, 1), (1, 1, None, 9, 1)])
    assert column(cl.merge_duplicates(df), "sales") == [5.0, 0.0]
    assert column(cl.merge_duplicates(df, keep_missing=True), "sales") == [5.0, None]
    assert column(cl.merge_duplicates(df), "onpromotion") == [2, 1]


def test_clip_keeps_null(one):
    assert column(cl.clip_negative(one([-3, None, 4])), "sales") == [0.0, None, 4.0]


@pytest.mark.parametrize(
    ("days", "values", "filled"),
    [([1, 2, 5, 9, 10], [1, None, None, 4, None], [1, 1.375, 2.5, 4, 4]), ([1, 2, 5, 9], [None, 2, None, 4], [0, 2, 2.857142857142857, 4])],
)
def test_short_gaps_are_linear_in_time(panel, days, values, filled):
    df = panel([(d, 1, "A", v) for d, v in zip(days, values)])
    assert column(cl.handle_missing(df), "sales") == pytest.approx(filled)


def test_medium_gap_takes_month_mean_of_carried_series(one):
    values = [10.0] * 5 + [None] * 10 + [40.0] * 5
    got = column(cl.handle_missing(one(values)), "sales")
    assert got[5:15] == pytest.approx([np.mean([10] * 15 + [40] * 5)] * 10)


def test_long_gap_takes_median_and_leading_nulls_are_included(one):
    got = column(cl.handle_missing(one([None] * 31 + [1.0, 5.0, 100.0])), "sales")
    assert got == [5.0] * 31 + [1.0, 5.0, 100.0]


def test_rule_is_chosen_per_series(panel):
    rows = [(i, 1, "A", None if 3 <= i < 6 else i) for i in range(10)] + [(i, 2, "A", None if 0 < i < 39 else i) for i in range(40)]
    df = panel(rows)
    assert {r["store_nbr"]: r["max_run"] for r in cl.max_missing_run(df).collect()} == {1: 3, 2: 38}
    got = cl.handle_missing(df)
    assert column(got.filter("store_nbr = 1"), "sales") == pytest.approx(list(range(10)))
    assert column(got.filter("store_nbr = 2"), "sales")[1:39] == [19.5] * 38


def test_all_null_series_becomes_zero(one):
    assert column(cl.handle_missing(one([None, None])), "sales") == [0.0, 0.0]


def test_promo_fills_forward_then_backward(panel):
    df = panel([(i, 1, "A", 1, p) for i, p in enumerate([None, 3, None, 5, None])])
    assert column(cl.fill_promo(df), "onpromotion") == [3, 3, 3, 5, 5]
    assert column(cl.fill_promo(panel([(0, 1, "A", 1, None)])), "onpromotion") == [0]


def test_gap_filling_is_reached_by_clean_only_when_asked(spark, one):
    df = one([2, None, 6])
    assert column(cl.clean(df, no_events(spark)), "sales") == [2.0, 0.0, 6.0]
    assert column(cl.clean(df, no_events(spark), keep_missing=True), "sales") == [2.0, 4.0, 6.0]


def test_event_days_ignore_locale_by_default(spark):
    cal = events(spark, [("2020-01-01", "Holiday", "Local", False), ("2020-01-02", "Event", "National", True), ("2020-01-03", "Bridge", "National", False), ("2020-01-01", "Event", "National", False)])
    assert cl.load_events(cal).count() == 1
    assert cl.load_events(cal, "Local").count() == 1
    assert cl.load_events(cal, "Regional").count() == 0


def sequential(values, protected):
    """The stated rule, value by value: earlier neighbours count with what they became."""
    now, hit = list(values), [False] * len(values)
    q1, q3 = np.percentile(values, [25, 75])
    for i, v in enumerate(values):
        med = statistics.median(values[max(0, i - 3) : i + 4])
        if i in protected or not (med > 0 and v > 10 * med and v > q3 + 3 * (q3 - q1)):
            continue
        near = now[max(0, i - 3) : i] + now[i + 1 : i + 4]
        if all(n < v * 0.5 for n in near):
            now[i], hit[i] = med, True
    return now, hit


def test_spikes_equal_the_sequential_scan(spark):
    rng = random.Random(7)
    rows, wanted, days = [], {}, set()
    start = dt.date(2020, 1, 1)
    protected = {4, 17}
    for store in range(1, 1201):
        n = rng.choice([1, 3, 8, 20, 40])
        values = [rng.choice([0.0, 1.0, 2.0, 3.0]) for _ in range(n)]
        for _ in range(rng.randint(0, 6)):
            values[rng.randrange(n)] = rng.choice([40.0, 90.0, 150.0, 400.0, 1000.0])
        wanted[store] = sequential(values, protected)
        rows += [(start + dt.timedelta(days=i), store, "A", v, 0) for i, v in enumerate(values)]
    cal = events(spark, [(str(start + dt.timedelta(days=d)), "Holiday", "N", False) for d in protected])
    got = {}
    for r in cl.handle_outliers(spark.createDataFrame(rows, PANEL_SCHEMA), cal).orderBy("store_nbr", "date").collect():
        got.setdefault(r["store_nbr"], ([], []))
        got[r["store_nbr"]][0].append(r["sales"])
        got[r["store_nbr"]][1].append(r["is_outlier"])
    assert got == wanted
    assert sum(sum(h) for _, h in wanted.values()) > 300


def test_adjacent_spikes_depend_on_order(spark, one):
    quiet = [1.0] * 12
    up, down = quiet[:5] + [100.0, 1000.0] + quiet, quiet[:5] + [1000.0, 100.0] + quiet
    for values in (up, down):
        got = column(cl.handle_outliers(one(values), no_events(spark)), "sales")
        assert got == sequential(values, set())[0]
    assert column(cl.handle_outliers(one(up), no_events(spark)), "sales")[5] == 100.0  # judged before its larger neighbour is replaced
    assert column(cl.handle_outliers(one(down), no_events(spark)), "sales")[6] == 1.0


def test_event_day_keeps_its_spike(spark, one):
    cal = events(spark, [("2020-01-06", "Event", "Local", False)])
    got = cl.handle_outliers(one([1.0] * 5 + [500.0] + [1.0] * 9), cal)
    assert column(got, "sales")[5] == 500.0
    assert column(got, "is_event")[5] and not any(column(got, "is_outlier"))


def test_clean_is_unique_and_not_negative_without_promo_column(spark, panel):
    rows = [(i, s, "A", (-5 if i % 15 == 0 else None if i % 20 == 0 else i)) for i in range(60) for s in (1, 2)]
    got = cl.clean(panel(rows + rows[:4], promo=False), no_events(spark))
    assert got.columns == ["date", "family", "store_nbr", "sales", "is_event", "is_outlier"]
    assert got.count() == got.select("date", "store_nbr", "family").distinct().count() == 120
    assert got.filter("sales is null or sales < 0").count() == 0


def test_hot_series_with_a_third_of_all_rows(spark):
    """One key holds most raw rows; after the merge it is one row like any other."""
    hot = spark.range(200_000).select(F.lit(dt.date(2020, 1, 5)).alias("date"), F.lit(1).alias("store_nbr"), F.lit("A").alias("family"), F.lit(1.0).alias("sales"))
    rest = spark.range(100_000).select(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 10).cast("int")).alias("date"), (2 + F.col("id") % 50).cast("int").alias("store_nbr"), F.lit("A").alias("family"), F.lit(1.0).alias("sales"))
    got = cl.clean(hot.union(rest), no_events(spark))
    assert got.filter("store_nbr = 1").first()["sales"] == 200_000.0
    assert got.agg(F.sum("sales")).first()[0] == 300_000.0


def test_plan_has_one_shuffle_for_all_windows(spark, one):
    plan = cl.handle_missing(one([1, None, 2]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
