from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from shelfcast.operators import aggregate as agg
from shelfcast.operators import analysis as an
from shelfcast.operators import decompose as dc


def rows_of(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_trend_daily_fills_missing_days_and_keeps_order(panel):
    df = panel([("2020-01-01", 1, "A", 3), ("2020-01-04", 1, "A", 5), ("2020-01-04", 2, "B", 1)])
    assert rows_of(an.trend(df, "daily"), "label", "sales") == [("2020-01-01", 3.0), ("2020-01-02", 0.0), ("2020-01-03", 0.0), ("2020-01-04", 6.0)]
    assert rows_of(an.trend(df, "daily", "A", 1), "label", "sales")[-1] == ("2020-01-04", 5.0)


def test_trend_spine_ends_with_the_selection(panel):
    df = panel([("2020-01-01", 1, "A", 3), ("2020-01-03", 1, "A", 3), ("2020-02-04", 1, "B", 5)])
    assert len(an.trend(df, "daily", "A").collect()) == 3
    assert an.trend(df, "daily", "NONE").collect() == []


@pytest.mark.parametrize("freq, granularity, label", [("W", "weekly", "%Y-W%W"), ("ME", "monthly", "%Y-%m")])
def test_trend_buckets(panel, freq, granularity, label):
    days = ["2019-12-29", "2019-12-31", "2020-01-05", "2020-01-06", "2020-03-01", "2021-02-28"]
    df = panel([(d, 1, "A", i + 1) for i, d in enumerate(days)])
    want = pd.Series(range(1, 7), index=pd.to_datetime(days), dtype=float).resample(freq).sum()
    assert rows_of(an.trend(df, granularity), "label", "sales") == [(d.strftime(label), v) for d, v in want.items()]


def test_long_daily_trend_turns_weekly_on_demand_and_unknown_is_refused(one):
    labels = rows_of(an.trend(one([1.0] * 366), "daily", weekly_above=365), "label")
    assert labels[0][0] == "2020-W00" and len(labels) == 53
    assert rows_of(an.trend(one([1.0] * 365), "daily", weekly_above=365), "label")[0][0] == "2020-01-01"
    assert len(rows_of(an.trend(one([1.0] * 400), "daily"), "label")) == 400
    with pytest.raises(ValueError):
        an.trend(one([1.0]), "hourly")


def test_yoy_compares_present_years(panel):
    df = panel([("2017-05-01", 1, "A", 200), ("2019-05-01", 1, "A", 150)])
    assert rows_of(an.yoy_growth(df), "year", "previous_year", "yoy_growth") == [(2019, 2017, -25.0)]
    assert an.yoy_growth(panel([("2017-05-01", 1, "A", 200)])).first()["yoy_growth"] is None
    assert an.yoy_growth(panel([("2017-05-01", 1, "A", 0), ("2018-05-01", 1, "A", 5)])).first()["yoy_growth"] is None


def test_overview(panel):
    df = panel([("2019-01-01", 1, "EGGS", 10), ("2019-01-02", 2, "DELI", 10), ("2020-01-01", 1, "DELI", 0), ("2020-01-01", 1, "EGGS", 0)])
    r = an.overview(df).first()
    assert (r["total_sales"], r["days"], r["store_count"], r["family_count"], r["yoy_growth"]) == (20.0, 3, 2, 2, -100.0)
    assert (r["best_family"], r["best_family_label"], r["best_family_sales"]) == ("DELI", "熟食", 10.0)  # a tie goes to the first name
    assert r["avg_daily_sales"] == pytest.approx(20 / 3)


def test_monthly_comparison_needs_thirteen_months(panel):
    short = panel([("2019-01-01", 1, "A", 1), ("2020-01-31", 1, "A", 1)])
    assert an.monthly_comparison_long(short).count() == 0 and an.monthly_comparison(short).count() == 0
    df = panel([("2019-01-01", 1, "A", 1), ("2020-02-01", 1, "A", 2)])
    got = {r["month"]: (r["2019"], r["2020"]) for r in an.monthly_comparison(df).collect()}
    assert len(got) == 12 and got[1] == (1.0, None) and got[2] == (None, 2.0) and got[12] == (None, None)


def test_shares_sum_to_hundred_and_zero_total_is_null(panel):
    df = panel([(0, 1, f, v) for f, v in (("B", 1), ("A", 2), ("C", 4))])
    assert sum(r["share"] for r in an.category_share(df).collect()) == pytest.approx(100)
    assert an.category_share(panel([(0, 1, "A", 0)])).first()["share"] is None


def test_top_families_clamp_ties_and_missing_promo(panel):
    rows = [(0, 1, f, v, p) for f, v, p in (("B", 5, 1), ("A", 5, 3), ("C", 9, 0))]
    assert rows_of(an.top_families(panel(rows), 2), "family", "onpromotion_avg") == [("C", 0.0), ("A", 3.0)]
    assert an.top_families(panel(rows), 0).count() == 1
    assert rows_of(an.top_families(panel(rows, promo=False), 99), "onpromotion_avg") == [(None,)] * 3


def test_correlation_matrix(panel):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 50, 60), rng.integers(0, 50, 60)
    rows = [(i, 1, "A", v) for i, v in enumerate(a)] + [(i, 1, "B", v) for i, v in enumerate(b) if i % 3] + [(i, 1, "K", 7) for i in range(60)]
    got = {(r["family_1"], r["family_2"]): r["corr"] for r in an.correlation(panel(rows)).collect()}
    want = np.corrcoef(a, np.where(np.arange(60) % 3, b, 0))[0, 1]
    assert got[("A", "B")] == pytest.approx(want) and got[("B", "A")] == pytest.approx(want) and got[("A", "A")] == pytest.approx(1)
    assert len(got) == 9 and all(got[k] is None for k in got if "K" in k)
    assert an.correlation(panel(rows[:60])).count() == 0


def test_weekday_pattern_has_seven_rows(panel):
    got = dict(rows_of(an.weekday_pattern(panel([("2020-01-06", 1, "A", 2), ("2020-01-13", 1, "A", 4)])), "weekday", "avg_sales"))
    assert got == {0: 3.0, **{d: 0.0 for d in range(1, 7)}}


def test_promotion(panel):
    df = panel([(0, 1, "A", 10, 1), (1, 1, "A", 5, 0), (0, 1, "B", 8, 0), (0, 1, "C", 4, 2), (0, 1, "D", 0, 0), (1, 1, "D", 6, 1)])
    assert rows_of(an.promo_effect(df, "A"), "promo_avg", "non_promo_avg", "lift") == [(10.0, 5.0, 2.0)]
    assert rows_of(an.promo_effect(df, "B"), "promo_avg", "non_promo_avg", "lift") == [(0.0, 8.0, 0.0)]
    assert rows_of(an.promo_effect(df, "C"), "promo_avg", "non_promo_avg", "lift") == [(4.0, 0.0, None)]
    assert rows_of(an.promo_effect_by_family(df), "family", "promo_avg", "non_promo_avg", "lift") == [
        ("A", 10.0, 5.0, 2.0), ("B", None, 8.0, None), ("C", 4.0, None, None), ("D", 6.0, 0.0, None)
    ]


def test_totals_agree(panel):
    df = panel([(i % 7, 1 + i % 3, "AB"[i % 2], i) for i in range(50)])
    sets = agg.totals_grouping_sets(df).collect()
    for kind in ("date", "family", "store"):
        assert sum(r["total_sales"] for r in sets if r["kind"] == kind) == sum(range(50))
    s = agg.dataset_summary(df).first()
    assert (s["total_rows"], s["days"], s["family_count"], s["stores"], s["missing_after"]) == (50, 7, 2, [1, 2, 3], 0)
    assert [f["name"] for f in s["families"]] == ["A", "B"]


def test_report_sections(panel):
    df = panel([(i, 1 + i % 2, "AB"[i % 2], 1 + i % 9, i % 3) for i in range(500)])
    got = {r["section"] for r in an.analysis_report(df).select("section").distinct().collect()}
    assert got == {"overview", "trend", "monthly", "share", "top", "correlation", "weekday", "promo", "promo_by_family"}


def test_decomposition_adds_up_and_finds_the_season(one, panel):
    t = np.arange(200)
    season = 5 * np.sin(2 * np.pi * t / 7)
    rng = np.random.default_rng(0)
    got = dc.seasonal_decomposition(one(list(50 + 0.1 * t + season + rng.normal(0, 0.1, 200)))).orderBy("date").toPandas()
    assert np.allclose(got["observed"], got["trend"] + got["seasonal"] + got["residual"])
    assert np.abs(got["seasonal"] - season).max() < 0.6 and np.abs(got["trend"] - 50 - 0.1 * t).max() < 0.6


def test_decomposition_resists_an_outlier(one):
    t = np.arange(140)
    y = 50 + 5 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(0).normal(0, 1, 140)
    y[70] += 500
    got = dc.seasonal_decomposition(one(list(y))).orderBy("date").toPandas()
    assert abs(got["residual"][70] - 500) < 5 and got["residual"].drop(70).abs().max() < 6


def test_undecomposable_series_have_a_reason(panel):
    df = panel([(i, 1, "A", 5) for i in range(30)] + [(i, 2, "A", i) for i in range(10)] + [(i, 3, "A", i % 7) for i in range(30)])
    status = {r["store_nbr"]: r["reason"] for r in dc.decomposition_status(df).collect()}
    assert status == {1: "constant series", 2: "series too short", 3: "ok"}
    assert {r["store_nbr"] for r in dc.seasonal_decomposition(df).collect()} == {3}
    assert dc.seasonal_decomposition(df, series=()).count() == 30


def test_classical_decomposition_adds_up(one):
    got = an.seasonal_classical(one([float(10 + i % 7) for i in range(35)])).toPandas()
    assert np.allclose(got["observed"], got["trend"] + got["seasonal"] + got["residual"])
    assert an.seasonal_classical(one([1.0] * 13)).count() == 0


def test_top_families_honours_its_number(panel):
    df = panel([(0, 1, f"F{i:02d}", i) for i in range(60)])
    assert an.top_families(df, 50).count() == 50


def test_analyses_without_promotions(panel):
    rows = [(d, 1, f, d + 1 + (f == "B")) for d in range(40) for f in "AB"]
    df = panel(rows, promo=False)
    assert an.promo_effect(df).count() == 0 == an.promo_effect_by_family(df, None).count()
    sections = {r["section"] for r in an.analysis_report(df).collect()}
    assert {"overview", "trend", "share", "top", "weekday"} <= sections and not sections & {"promo", "promo_by_family"}


def test_correlation_on_large_sums(panel):
    x = np.array([[1.0, 2, 3, 4, 5, 6], [2.0, 1, 4, 3, 6, 6], [7.0] * 6])
    rows = [(d, 1, f, 1e9 + x[i, d]) for i, f in enumerate("ABC") for d in range(6)]
    got = {(r["family_1"], r["family_2"]): r["corr"] for r in an.correlation(panel(rows)).collect()}
    assert len(got) == 9 and abs(got["A", "B"] - np.corrcoef(x[:2])[0, 1]) < 1e-9 and got["A", "B"] == got["B", "A"]
    assert got["A", "C"] is None and got["C", "C"] is None


def test_correlation_counts_missing_days_as_zero(panel):
    a, b = [5.0, 0, 3, 1], [0.0, 2, 0, 4]
    rows = [(d, 1, f, v) for f, vs in (("A", a), ("B", b)) for d, v in enumerate(vs) if v]
    got = {(r["family_1"], r["family_2"]): r["corr"] for r in an.correlation(panel(rows)).collect()}
    assert abs(got["A", "B"] - np.corrcoef(a, b)[0, 1]) < 1e-12
