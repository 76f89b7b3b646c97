from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions import solvers
from shelfcast.operators import decompose as dc
from shelfcast.operators import forecast as fc
from tests import plain_arma


def calendar(spark, rows=()):
    return spark.createDataFrame(list(rows), "date date, type string, locale string, description string, transferred boolean")


def wave(n):
    return [100 + 5 * math.sin(i / 10) + 0.2 * i for i in range(n)]


def autoregressive(n, phi=0.7, seed=0):
    rng, y = np.random.default_rng(seed), [50.0]
    for e in rng.normal(0, 1, n - 1):
        y.append(15 + phi * y[-1] + e)
    return np.array(y)


# Unit root test


def test_p_value_meets_published_critical_values():
    for tau, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert solvers.unit_root_p(tau) == pytest.approx(p, abs=0.002)
    assert solvers.unit_root_p(3.0) == 1.0 and solvers.unit_root_p(-20.0) == 0.0


def test_differences_of_known_series():
    noise = np.random.default_rng(2).normal(size=400)
    assert solvers.difference_order(noise) == 0
    assert solvers.difference_order(np.cumsum(noise)) == 1
    assert solvers.difference_order(np.cumsum(np.cumsum(noise))) == 2
    assert solvers.difference_order(np.ones(50)) == 1  # a constant cannot be tested


def test_statistic_equals_plain_regression():
    y = autoregressive(200)
    stat, _, k = solvers.adf(y)
    dy = np.diff(y)
    x = np.column_stack([np.ones(len(dy) - k), y[k:-1], *[dy[k - j : len(dy) - j] for j in range(1, k + 1)]])
    beta = np.linalg.solve(x.T @ x, x.T @ dy[k:])
    s2 = np.sum((dy[k:] - x @ beta) ** 2) / (len(x) - x.shape[1])
    assert stat == pytest.approx(beta[1] / math.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1]))


def test_stationarity_per_series(panel):
    walk = np.cumsum(np.random.default_rng(5).normal(size=300)) + 500
    noise = np.random.default_rng(6).normal(size=300) + 50
    rows = [(i, 1, "A", v) for i, v in enumerate(walk)] + [(i, 2, "A", v) for i, v in enumerate(noise)]
    rows += [(i, 3, "A", 7) for i in range(60)] + [(i, 4, "A", i) for i in range(19)]
    got = {r["store_nbr"]: r for r in dc.adf_stationarity(panel(rows)).collect()}
    assert (got[1]["is_stationary"], got[1]["suggested_d"]) == (False, 1)
    assert (got[2]["is_stationary"], got[2]["suggested_d"]) == (True, 0)
    assert got[3]["reason"] == "constant series" and got[3]["p_value"] is None
    assert got[4]["reason"] == "series too short"
    orders = {r["store_nbr"]: r["d"] for r in dc.difference_order(panel(rows)).collect()}
    assert (orders[1], orders[2], orders[3]) == (1, 0, 1)


# Autoregressive model


def test_coefficients_are_recovered():
    found = solvers.arma_candidates(autoregressive(3000), [(1, 0)], constant=True)[(1, 0)]
    assert found["phi"][0] == pytest.approx(0.7, abs=0.04) and found["sigma2"] == pytest.approx(1, abs=0.1)
    rng = np.random.default_rng(1)
    e = rng.normal(size=4001)
    found = solvers.arma_candidates(10 + e[1:] + 0.6 * e[:-1], [(0, 1)], constant=True)[(0, 1)]
    assert found["theta"][0] == pytest.approx(0.6, abs=0.05)


def test_forecast_of_a_first_order_model_is_its_formula():
    y = autoregressive(500)
    m = solvers.arma_candidates(y, [(1, 0)], constant=True)[(1, 0)]
    path, se = plain_arma.arima_forecast(y, 0, m, 5)
    want, phi = y[-1], m["phi"][0]
    for h, v in enumerate(path, 1):
        want = m["const"] + phi * want
        assert v == pytest.approx(want)
        assert se[h - 1] == pytest.approx(math.sqrt(m["sigma2"] * sum(phi ** (2 * j) for j in range(h))))


def test_integrated_forecast_continues_a_line():
    y = np.arange(100, dtype=float)
    flat = dict(const=0.0, phi=np.zeros(0), theta=np.zeros(0), sigma2=1.0)
    assert plain_arma.arima_forecast(y, 2, flat, 4)[0] == pytest.approx([100, 101, 102, 103])
    assert plain_arma.arima_forecast(y, 1, flat, 3)[1] == pytest.approx(np.sqrt([1, 2, 3]))


def test_one_step_errors_of_a_moving_average():
    rng = np.random.default_rng(4)
    e = rng.normal(size=300)
    y = e + 0.5 * np.r_[0, e[:-1]]
    m = dict(const=0.0, phi=np.zeros(0), theta=np.array([0.5]), sigma2=1.0)
    assert plain_arma.arma_shocks(y, m) == pytest.approx(e)


def test_arima_rows(one):
    df = one(wave(120))
    got = fc.arima_forecast(df, 7).orderBy("date").collect()
    assert len(got) == 7 and got[0]["date"] == dt.date(2020, 1, 1) + dt.timedelta(days=120)
    assert all(0 <= r["lower_ci"] <= r["forecast"] <= r["upper_ci"] for r in got)
    order = fc.order_search(df).first()
    assert (got[0]["p"], got[0]["d"], got[0]["q"]) == (order["p"], order["d"], order["q"]) and order["p"] in range(4) and order["q"] in range(4)
    assert fc.fitted_vs_actual(df).count() == 120
    test = fc.backtest_arima(df)
    assert test.count() == 120 - int(120 * (0.7 + 0.15)) and test.filter("predicted < 0").count() == 0


def test_order_search_takes_the_least_criterion(panel):
    df = panel([(i, 1, "A", v) for i, v in enumerate(autoregressive(300))])
    for criterion in ("aic", "bic"):
        best = fc.order_search(df, criterion).first()
        least = fc.order_candidates(df).agg(F.min(criterion)).first()[0]
        assert best[criterion] == least


def test_constant_and_zero_series_get_a_forecast(panel):
    df = panel([(i, 1, "A", 0) for i in range(60)] + [(i, 2, "A", 8) for i in range(60)] + [(i, 3, "A", i) for i in range(29)])
    got = fc.arima_forecast(df, 7).groupBy("store_nbr").agg(F.count("*").alias("n"), F.max("forecast").alias("top")).collect()
    assert {r["store_nbr"]: (r["n"], r["top"]) for r in got} == {1: (7, 0.0), 2: (7, 8.0)}  # 29 rows are too few


def test_rolling_mean_backtest_skips_validation(one):
    values = [float((i * 37) % 23) for i in range(60)]
    a, b = int(60 * 0.7), int(60 * (0.7 + 0.15))
    history, want = values[:a], []
    for v in values[b:]:
        want.append(sum(history[-7:]) / 7)
        history.append(v)
    got = [r["predicted"] for r in fc.backtest_rolling_mean(one(values)).orderBy("date").collect()]
    assert got == pytest.approx(want)


# Decomposable model


def test_decomposable_recovers_trend_and_week(spark, one):
    t = np.arange(420)
    y = 100 + 0.2 * t + 10 * np.sin(2 * np.pi * t / 7)
    got = fc.decomposable_forecast(one(list(y)), calendar(spark), 28, multiplicative=False).orderBy("date").toPandas()
    future = np.arange(420, 448)
    assert np.abs(got["weekly"] - 10 * np.sin(2 * np.pi * future / 7)).max() < 1.5
    assert np.abs(got["forecast"] - (100 + 0.2 * future + 10 * np.sin(2 * np.pi * future / 7))).mean() < 8
    assert (got["lower_ci"] <= got["forecast"]).all() and (got["forecast"] <= got["upper_ci"]).all()


def test_multiplicative_handles_zero_and_stays_positive(spark, one):
    got = fc.decomposable_forecast(one([0.0, 4.0, 9.0] * 40), calendar(spark), 10).toPandas()
    assert len(got) == 10 and (got[["forecast", "lower_ci", "upper_ci"]] >= 0).all().all() and got["forecast"].notna().all()


def test_holiday_effect_is_learned_and_applied(spark, one):
    y = [50.0] * 400
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=d) for d in (60, 120, 180, 240, 300, 405)]
    for d in (60, 120, 180, 240, 300):
        y[d] = 90.0
    cal = calendar(spark, [(d, "Event", "N", "Fair", False) for d in days])
    got = fc.decomposable_forecast(one(y), cal, 10, multiplicative=False).orderBy("date").toPandas()
    assert got["holidays"][5] > 25 and got["holidays"].drop(5).abs().max() == 0


def test_promotion_regressor(spark, panel):
    rows = [(i, 1, "A", 50 + 20 * (i % 5 == 0), int(i % 5 == 0)) for i in range(200)]
    df = panel(rows)
    plan = spark.createDataFrame([("A", 1, 2, 1)], "family string, store_nbr int, step int, onpromotion long")
    got = fc.decomposable_forecast(df, calendar(spark), 5, False, True, plan).orderBy("date").toPandas()
    assert got["forecast"][1] - got["forecast"].drop(1).mean() > 12


def test_changepoints_are_in_the_first_part(spark, one):
    df = one([float(min(i, 100)) for i in range(200)])
    got = fc.changepoints(df, calendar(spark), multiplicative=False).orderBy("date").toPandas()
    assert len(got) == 25 and max(got["date"]) <= dt.date(2020, 1, 1) + dt.timedelta(days=160)
    assert got["delta"].min() < 0  # the line bends down in the middle


def test_a_single_bend_is_found_and_others_are_zero(spark, one):
    noise = np.random.default_rng(7).normal(0, 0.5, 1501)
    df = one([float(100 + 0.5 * min(i, 576) + noise[i]) for i in range(1501)])  # bends at 0.384 of the span, where the twelfth may be
    got = fc.changepoints(df, calendar(spark), multiplicative=False).orderBy("date").toPandas()
    near = got["delta"][10:13].sum()
    assert near == pytest.approx(-0.5 * 1500, rel=0.1)
    assert (got["delta"].drop([10, 11, 12]).abs() < 0.02 * abs(near)).all() and (got["delta"] == 0).sum() >= 12


def test_the_interval_widens_with_the_horizon(spark, one):
    df = one([float(50 + 0.4 * min(i, 576) + 3 * math.sin(i)) for i in range(1501)])
    got = fc.decomposable_forecast(df, calendar(spark), 60, multiplicative=False).orderBy("date").toPandas()
    width = (got["upper_ci"] - got["lower_ci"]).to_numpy()
    assert (np.diff(width) > 0).all() and width[-1] > 1.05 * width[0]


def test_sparse_solver_meets_its_optimality_conditions():
    rng = np.random.default_rng(3)
    x, scales = rng.normal(size=(200, 9)), np.r_[5.0, 5.0, np.full(5, 0.05), 10.0, 10.0]
    y = x @ np.r_[1.0, -2.0, 0.0, 0.6, 0.0, 0.0, -0.4, 0.5, 0.0] + rng.normal(0, 0.5, 200)
    beta, spread = solvers.sparse_ridge(x, y, scales, slice(2, 7), rounds=40)
    slope = x.T @ (y - x @ beta) / spread**2
    assert slope[[0, 1, 7, 8]] == pytest.approx((beta / scales**2)[[0, 1, 7, 8]], abs=1e-3)
    on = beta[2:7] != 0
    assert slope[2:7][on] == pytest.approx(np.sign(beta[2:7][on]) / 0.05, rel=1e-4) and (np.abs(slope[2:7]) <= 20 + 1e-3).all() and 1 <= on.sum() < 5


def test_decomposable_backtest_covers_the_test_part(spark, one):
    got = fc.backtest_decomposable(one(wave(200)), calendar(spark)).orderBy("date").toPandas()
    assert len(got) == 200 - int(200 * (0.7 + 0.15)) and (np.abs(got["actual"] - got["predicted"]) / got["actual"]).mean() < 0.4


# Window model


def test_trees_equal_their_own_model_and_stop_early(spark, panel):
    rng, rows = np.random.default_rng(1), []
    for store in (1, 2):
        y = 20.0
        for i in range(400):
            y = (60.0 if y < 50 else 30.0) + rng.normal(0, 4)  # a step that no line follows
            rows.append((i, store, "A", y))
    df = panel(rows)
    windows = fc.model_windows(df, 5).cache()
    trees = fc.fit_trees(windows, rounds=30, depth=3)
    assert 1 <= len(trees.roots) < 30 and trees.depth <= 3
    loss = {r["split"]: r["loss"] for r in fc.window_loss(windows, trees).collect()}
    line = {r["split"]: r["loss"] for r in fc.window_loss(windows, *fc.fit_window_model(windows)).collect()}
    assert loss["val"] < line["val"]

    def walk(window, at):
        while trees.left[at] != at:
            at = trees.left[at] if window[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        return trees.value[at]

    for r in windows.select("window", fc._predict(F.col("window"), trees).alias("x")).limit(100).collect():
        assert r["x"] == pytest.approx(sum(w * walk(r["window"], at) for w, at in zip(trees.weights, trees.roots)), abs=1e-12)
    path = fc.recursive_forecast(df, trees, horizon=6, length=5).filter("store_nbr = 1").orderBy("date").toPandas()["forecast"]
    assert len(path) == 6 and (path >= 0).all() and ((path < 50).astype(int).diff().abs().dropna() == 1).mean() > 0.5


def test_exported_trees_predict_as_the_fitted_model(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor

    rng = np.random.default_rng(5)
    data = [([float(v) for v in x], float(np.sin(4 * x[0]) + (x[1] > 0.5) * x[2]), "val" if i % 5 == 0 else "train") for i, x in enumerate(rng.random((400, 3)))]
    windows = spark.createDataFrame(data, "window array<double>, label double, split string").coalesce(1).cache()
    rows = windows.select("*", array_to_vector("window").alias("features"), (F.col("split") == "val").alias("held"))
    model = GBTRegressor(maxIter=10, maxDepth=3, stepSize=0.2, validationIndicatorCol="held", validationTol=1e-3, seed=1, cacheNodeIds=False).fit(rows)
    trees = fc.fit_trees(windows, rounds=10, depth=3)
    gap = model.transform(rows).select(F.max(F.abs(F.col("prediction") - fc._predict(F.col("window"), trees)))).first()[0]
    assert len(trees.roots) == len(model.trees) and gap < 1e-12


def test_window_model_learns_a_linear_rule(panel):
    rng, rows = np.random.default_rng(0), []
    for store in (1, 2, 3):
        y = list(rng.uniform(0, 100, 7))
        for _ in range(193):
            y.append(y[-7])
        rows += [(i, store, "A", v) for i, v in enumerate(y)]
    df = panel(rows)
    model = fc.fit_window_model(fc.model_windows(df))
    got = fc.recursive_forecast(df, *model, horizon=14).orderBy("store_nbr", "date").toPandas()
    assert len(got) == 42
    for store in (1, 2, 3):
        values = [r[3] for r in rows if r[1] == store]
        path = [values[-7 + h % 7] for h in range(14)]
        assert np.abs(got[got["store_nbr"] == store]["forecast"].to_numpy() - path).max() < 5
    back = fc.backtest_window(df, *model).orderBy("date").toPandas()
    assert len(back) == 3 * 30
    # The validation part is cut out of the history: the week fits again once a window has passed the cut.
    assert np.abs(back["actual"] - back["predicted"]).tail(3).max() < 1


def test_windows_stay_inside_their_part(one):
    got = fc.model_windows(one([float(i) for i in range(300)])).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 210 - 30, "val": 45 - 30}


def test_short_series_get_a_shorter_window(panel):
    df = panel([(i, 1, "A", i % 9) for i in range(60)] + [(i, 2, "A", i % 9) for i in range(300)] + [(i, 3, "A", 1) for i in range(5)])
    got = {r["store_nbr"]: (r["window"], r["reason"]) for r in fc.short_series_window(df).collect()}
    assert got == {1: (8, "ok"), 2: (30, "ok"), 3: (0, "series too short")}
    recent = {r["store_nbr"]: len(r["window"]) for r in fc.recent_window(df).collect()}
    assert recent == {1: 8, 2: 30}
    forecast = fc.window_forecast(df, 7).groupBy("store_nbr").count().collect()
    assert {r["store_nbr"]: r["count"] for r in forecast} == {1: 7, 2: 7}


def test_recent_window_is_the_scaled_end(one):
    values = [float(i % 50) for i in range(400)]
    r = fc.recent_window(one(values)).first()
    assert r["window"] == pytest.approx([v / 49 for v in values[-30:]]) and r["last_date"] == dt.date(2020, 1, 1) + dt.timedelta(days=399)


# Stored results


def test_fingerprint_follows_content_not_order(panel):
    rows = [(i, 1, "A", i) for i in range(20)]
    mark = lambda r: fc.series_fingerprint(panel(r)).first()["fingerprint"]
    base = mark(rows)
    assert base == mark(rows[::-1])
    swapped = [(0, 1, "A", 1), (1, 1, "A", 0), *rows[2:]]
    assert len({base, mark(swapped), mark(rows[1:]), mark(rows + [(20, 1, "A", 0)]), mark([(0, 1, "A", 0.5), *rows[1:]])}) == 5


def test_only_changed_series_are_fitted(spark):
    cols = "model string, family string, store_nbr int, fingerprint string, config string"
    now = spark.createDataFrame([("ARIMA", "A", 1, "f1", "{}"), ("ARIMA", "A", 2, "f2", "{}"), ("LSTM", "A", 1, "f1", "{}")], cols)
    stored = spark.createDataFrame([("ARIMA", "A", 1, "f1", "{}"), ("ARIMA", "A", 1, "f1", "{}"), ("ARIMA", "A", 2, "old", "{}"), ("LSTM", "A", 1, "f1", "other")], cols)
    hits = {(r["model"], r["store_nbr"]): r["cache_hit"] for r in fc.skip_unchanged(now, stored).collect()}
    assert hits == {("ARIMA", 1): True, ("ARIMA", 2): False, ("LSTM", 1): False}
    assert fc.to_fit(now, stored).count() == 2


def test_forecast_all_ranks_every_model(spark, panel):
    df = panel([(i, s, "A", 50 + (i * s) % 7) for s in (1, 2) for i in range(150)])
    got = fc.forecast_all(df, calendar(spark), 7).toPandas()
    assert len(got) == 2 * 3 * 7 and (got["forecast"] >= 0).all()
    for _, g in got.groupby("store_nbr"):
        assert sorted(g.drop_duplicates("model")["rank"]) == [1, 2, 3]


def test_status_names_the_series_left_out(panel):
    df = panel([(i, 1, "A", float(i)) for i in range(40)] + [(i, 2, "A", 1.0) for i in range(25)])
    assert {r["store_nbr"]: (r["days"], r["reason"]) for r in fc.forecast_status(df).collect()} == {1: (40, "ok"), 2: (25, "fewer than 30 days")}


def test_given_coefficients_equal_the_plain_recursion(spark, panel):
    rng, rows, given, plain = np.random.default_rng(8), [], [], {}
    orders = [(0, 0, 0), (1, 0, 0), (0, 1, 1), (3, 0, 3), (2, 2, 1), (0, 2, 0), (3, 1, 0), (1, 0, 2)]
    for store, (p, d, q) in enumerate(orders, 1):
        y = np.cumsum(rng.normal(0.3, 1, 60)) + 50
        m = dict(const=0.2 if d == 0 else 0.05, phi=np.array([0.5, -0.3, 0.2][:p]), theta=np.array([0.4, 0.3, -0.2][:q]), sigma2=1.5)
        rows += [(i, store, "A", v) for i, v in enumerate(y)]
        cell = (m["const"], [*m["phi"].tolist(), *[0.0] * (3 - p)], [*m["theta"].tolist(), *[0.0] * (3 - q)], m["sigma2"])
        given.append(("A", store, p, d, q, None, None, cell, cell))
        known = np.r_[y[:42], y[51:]]
        path, se = plain_arma.arima_forecast(y, d, m, 12)
        plain[store] = {"fitted": plain_arma.arima_one_step(y, d, m), "backtest": plain_arma.arima_one_step(known, d, m)[42:], "forecast": path, "se": se}
    model = "struct<const: double, phi: array<double>, theta: array<double>, sigma2: double>"
    models = spark.createDataFrame(given, f"family string, store_nbr int, p int, d int, q int, aic double, bic double, whole {model}, trained {model}")
    got = fc.apply_arima(panel(rows), models, 12).orderBy("store_nbr", "kind", "date").collect()
    for store, wanted in plain.items():
        for kind in ("fitted", "backtest", "forecast"):
            found = [r for r in got if r.store_nbr == store and r.kind == kind]
            assert [r.value for r in found] == pytest.approx(np.maximum(wanted[kind], 0).tolist())
            if kind == "forecast":
                assert [r.upper_ci for r in found] == pytest.approx(np.maximum(wanted[kind] + fc.Z95 * wanted["se"], 0).tolist())
                assert [r.lower_ci for r in found] == pytest.approx(np.maximum(wanted[kind] - fc.Z95 * wanted["se"], 0).tolist())


@pytest.mark.parametrize("lag", [0, 1, 3])
def test_unit_root_from_covariances(spark, panel, lag):
    rng = np.random.default_rng(9)
    series = [np.cumsum(rng.normal(0, 1, 80)) + 30, 20 + rng.normal(0, 1, 50), 5 + np.sin(np.arange(40)) + 0.1 * rng.normal(0, 1, 40)]
    df = panel([(i, s, "A", v) for s, y in enumerate(series, 1) for i, v in enumerate(y)] + [(i, 8, "A", 4.0) for i in range(30)] + [(i, 9, "A", float(i * i)) for i in range(3)])
    got = {r.store_nbr: r for r in dc.unit_root_given_lag(df, lag).collect()}
    for s, y in enumerate(series, 1):
        x, dy = solvers._adf_design(y, lag)
        beta, *_ = np.linalg.lstsq(x, dy, rcond=None)
        rest = dy - x @ beta
        error = np.linalg.inv(x.T @ x)[1, 1] * (rest @ rest) / (len(dy) - x.shape[1])
        assert got[s].statistic == pytest.approx(beta[1] / math.sqrt(error)) and got[s].n == len(dy)
        assert got[s].is_stationary == (solvers.unit_root_p(got[s].statistic) < 0.05)
    assert got[8].statistic is None and (9 not in got or got[9].statistic is None)


def test_difference_order_given_lag(spark, panel):
    rng = np.random.default_rng(10)
    steps = rng.normal(0, 1, (3, 300))
    series = [steps[0], np.cumsum(steps[1] + 0.5), np.cumsum(np.cumsum(steps[2]))]
    df = panel([(i, s, "A", v) for s, y in enumerate(series) for i, v in enumerate(y)] + [(0, 7, "A", 1.0)])
    assert {r.store_nbr: r.d for r in dc.difference_order_given_lag(df).collect()} == {0: 0, 1: 1, 2: 2, 7: 1}
