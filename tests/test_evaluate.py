from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from shelfcast.operators import evaluate as ev

PAIRS = "model string, family string, store_nbr int, date date, actual double, predicted double"
METRICS = "model string, family string, store_nbr int, mae double, rmse double, mape double, smape double, r2 double, sample_size long"
DAY = dt.date(2020, 1, 1)


@pytest.fixture
def metrics_of(spark):
    def run(actual, predicted):
        rows = [("M", "A", 1, DAY + dt.timedelta(days=i), a, p) for i, (a, p) in enumerate(zip(actual, predicted))]
        return ev.compute_all(spark.createDataFrame(rows, PAIRS)).first()

    return run


def test_goldens(metrics_of):
    assert metrics_of([1.0, 2.0, 3.0], [1.0, 2.0, 3.0])["mae"] == 0
    assert metrics_of([3.0, 4.0, 5.0], [2.0, 4.0, 6.0])["mae"] == pytest.approx(2 / 3)
    r = metrics_of([0.0, 100.0], [10.0, 90.0])
    assert r["mape"] == pytest.approx(10) and r["sample_size"] == 2  # a zero actual is skipped
    assert metrics_of([0.0, 0.0], [1.0, 2.0])["mape"] == 0


def test_against_numpy(metrics_of):
    rng = np.random.default_rng(1)
    a, p = rng.uniform(1, 9, 50), rng.uniform(1, 9, 50)
    r = metrics_of(a.tolist(), p.tolist())
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((a - p) ** 2)))
    assert r["mape"] == pytest.approx(np.mean(np.abs(a - p) / a) * 100)
    assert r["smape"] == pytest.approx(np.mean(2 * np.abs(a - p) / (a + p + 1e-8)) * 100)
    assert r["r2"] == pytest.approx(1 - np.sum((a - p) ** 2) / np.sum((a - a.mean()) ** 2))


def test_r2_of_a_constant_actual(metrics_of):
    assert metrics_of([2.0, 2.0], [2.0, 2.0])["r2"] == 1 and metrics_of([2.0, 2.0], [2.0, 3.0])["r2"] == 0


def test_not_a_number_becomes_zero(metrics_of):
    r = metrics_of([1.0, float("nan")], [1.0, 2.0])
    assert r["mae"] == 0 and r["rmse"] == 0


def table(spark, rows):
    return spark.createDataFrame(rows, METRICS)


def test_better_model_wins(spark):
    df = table(spark, [("X", "A", 1, 1.0, 2.0, 3.0, 4.0, 0.9, 10), ("Y", "A", 1, 5.0, 6.0, 7.0, 8.0, -2.0, 10)])
    assert {r["model"]: (r["rank"], r["score"]) for r in ev.compare_models(df).collect()} == {"X": (1, 1.0), "Y": (2, 0.0)}
    best = ev.best_model(ev.compare_models(df)).first()
    assert best["best_model"] == "X" and best["reason"] == "综合评分最高（MAPE: 3.0%）"
    radar = {(r["model"], r["indicator"]): r["value"] for r in ev.radar(df).collect()}
    assert radar[("X", "mae")] == 1 and radar[("Y", "r2")] == 0 and radar[("X", "r2")] == 0.9
    assert all(0 <= v <= 1 for v in radar.values()) and len(radar) == 10


def test_single_model_and_ties(spark):
    one = [("X", "A", 1, 1.0, 2.0, 3.0, 4.0, 0.5, 10)]
    r = ev.compare_models(table(spark, one)).first()
    assert (r["rank"], r["score"]) == (1, 1.0)
    tied = one + [("B", "A", 1, 1.0, 2.0, 3.0, 4.0, 0.5, 10)]
    got = {r["model"]: (r["rank"], r["score"]) for r in ev.compare_models(table(spark, tied)).collect()}
    assert got == {"B": (1, 1.0), "X": (2, 1.0)}


def test_weights(spark):
    rows = [("X", "A", 1, 0.0, 0.0, 9.0, 1.0, 0.0, 1), ("Y", "A", 1, 9.0, 9.0, 0.0, 1.0, 0.0, 1)]
    assert {r["model"]: r["score"] for r in ev.compare_models(table(spark, rows)).collect()} == {"X": 0.5, "Y": 0.5}


def test_ranks_are_per_series(spark):
    rows = [(m, "A", s, e, e, e, e, 0.0, 5) for s in (1, 2) for m, e in (("X", float(s)), ("Y", 1.5))]
    got = {(r["store_nbr"], r["model"]): r["rank"] for r in ev.compare_models(table(spark, rows)).collect()}
    assert got == {(1, "X"): 1, (1, "Y"): 2, (2, "X"): 2, (2, "Y"): 1}


def test_positions_align_to_the_shorter_side(spark):
    keys = "family string, store_nbr int, date date"
    actual = spark.createDataFrame([("A", 1, DAY + dt.timedelta(days=i), float(i)) for i in range(5)], keys + ", actual double")
    shifted = spark.createDataFrame([("A", 1, DAY + dt.timedelta(days=7 + i), 10.0 + i) for i in range(3)], keys + ", predicted double")
    got = [(r["actual"], r["predicted"]) for r in ev.align_pairs(actual, shifted).orderBy("pos").collect()]
    assert got == [(0.0, 10.0), (1.0, 11.0), (2.0, 12.0)]


def test_lines_hold_the_actual_once(spark):
    pairs = spark.createDataFrame([(m, "A", 1, DAY, 5.0, p) for m, p in (("X", 1.0), ("Y", None))], PAIRS)
    got = sorted((r["name"], r["value"]) for r in ev.actual_vs_predicted(pairs).collect())
    assert got == [("X", 1.0), ("Y", 0.0), ("actual", 5.0)]


def test_report(spark):
    df = table(spark, [("X", "EGGS", 1, 1.0, 2.0, 3.26, 4.0, 0.9, 10), ("Y", "EGGS", 1, 5.0, 6.0, 7.0, 8.0, 0.1, 10)])
    r = ev.evaluation_report(df, 14).first()
    assert (r["label"], r["forecast_days"], r["best_model"], r["reason"]) == ("蛋类", 14, "X", "综合评分最高（MAPE: 3.3%）")
    assert [m["rank"] for m in r["metrics_table"]] == [1, 2]
    bars = [(b["rank"], b["model"], b["metric"], b["value"]) for b in ev.metric_bars(ev.compare_models(df)).orderBy("rank", "metric").collect()]
    assert bars[0] == (1, "X", "mae", 1.0) and len(bars) == 6
