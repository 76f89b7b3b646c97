"""Forecasts of every series in one job.

Input is a clean panel: at most one row per series and day. Three models: an autoregressive one with
its order searched per series, a decomposable one (trend with changepoints, seasons, holidays), and
one window model shared by all series, linear or of boosted trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import arma, solvers
from shelfcast.functions.series import ordered, spread, whole
from shelfcast.functions.values import clip_low
from shelfcast.operators.decompose import key_schema, per_series
from shelfcast.operators.evaluate import compare_models, compute_all
from shelfcast.operators.features import (
    floor_zero,
    future_dates,
    future_regressor,
    holiday_windows,
    minmax_inverse,
    minmax_train,
    split_forecast,
)
from shelfcast.schema import MIN_SERIES_ROWS, SERIES, TRAIN_RATIO, VAL_RATIO, WINDOW_LENGTH

ORDERS = [(p, q) for p in range(4) for q in range(4)]
FALLBACK = (1, 1, 1)
Z95, Z80 = 1.959963984540054, 1.2815515655446004


# Autoregressive model: numpy per series, sixteen orders in one call so that the series is shipped once.


def _orders(y: np.ndarray) -> tuple[int, dict]:
    d = solvers.difference_order(y)
    return d, solvers.arma_candidates(np.diff(y, d), ORDERS, constant=d == 0)


def _fit(y: np.ndarray, order: tuple[int, int, int]) -> dict | None:
    p, d, q = order
    return solvers.arma_candidates(np.diff(y, d), [(p, q)], constant=d == 0).get((p, q))


def _mean_model(y: np.ndarray, d: int) -> dict:
    """What is left when no order can be fitted: the mean of the differenced series."""
    w = np.diff(y, d)
    sigma2 = max(float(np.var(w)), 1e-12)
    fit = len(w) * (math.log(2 * math.pi * sigma2) + 1)
    none = np.zeros(0)
    return dict(const=float(w.mean()), phi=none, theta=none, sigma2=sigma2, aic=fit + 4, bic=fit + 2 * math.log(len(w)))


def _choose(y: np.ndarray, criterion: str) -> tuple[tuple[int, int, int], dict]:
    """The order with the least criterion on y, and its fit; (1, 1, 1) when none fits."""
    d, found = _orders(y)
    if found:
        (p, q), model = min(found.items(), key=lambda kv: kv[1][criterion])
        return (p, d, q), model
    return FALLBACK, _fit(y, FALLBACK) or _mean_model(y, 1)


def _ends(n: int) -> tuple[int, int]:
    return int(n * TRAIN_RATIO), int(n * (TRAIN_RATIO + VAL_RATIO))


def order_candidates(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """(series, p, d, q, aic, bic) of every order that fits the training part."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf["sales"].to_numpy(float)
        d, found = _orders(y[: _ends(len(y))[0]]) if len(y) >= MIN_SERIES_ROWS else (1, {})
        rows = [(p, d, q, m["aic"], m["bic"]) for (p, q), m in found.items()]
        return pd.DataFrame(rows, columns=["p", "d", "q", "aic", "bic"])

    return per_series(spread(df.select(*series, "date", "sales"), series), run, "p int, d int, q int, aic double, bic double", series)


def order_search(df: DataFrame, criterion: str = "aic", series: Sequence[str] = SERIES) -> DataFrame:
    """The order with the least criterion per series, (1, 1, 1) for a series where none fits."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y, columns = pdf["sales"].to_numpy(float), ["p", "d", "q", "aic", "bic"]
        if len(y) < MIN_SERIES_ROWS:
            return pd.DataFrame(columns=columns)
        d, found = _orders(y[: _ends(len(y))[0]])
        if not found:
            return pd.DataFrame([(*FALLBACK, None, None)], columns=columns)
        (p, q), model = min(found.items(), key=lambda kv: (kv[1][criterion], kv[0]))
        return pd.DataFrame([(p, d, q, model["aic"], model["bic"])], columns=columns)

    return per_series(spread(df.select(*series, "date", "sales"), series), run, "p int, d int, q int, aic double, bic double", series)


def forecast_status(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Per series its days and 'ok', or why the models leave it out."""
    facts = df.groupBy(*series).agg(F.count("*").alias("days"))
    return facts.select(*series, "days", F.when(F.col("days") < MIN_SERIES_ROWS, f"fewer than {MIN_SERIES_ROWS} days").otherwise("ok").alias("reason"))


_MODEL = "const double, phi array<double>, theta array<double>, sigma2 double"
_FIT = f"p int, d int, q int, aic double, bic double, whole struct<{_MODEL}>, trained struct<{_MODEL}>"


def _points(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per series with its days and values in order."""
    points = F.sort_array(F.collect_list(F.struct("date", F.col("sales").alias("actual"))))
    return spread(df.select(*series, "date", "sales"), series).groupBy(*series).agg(points.alias("points"))


def _values(points: Column | str) -> Column:
    return F.transform(points, lambda x: x["actual"])


def _fitted(points: DataFrame, criterion: str) -> DataFrame:
    """Adds the columns of `fit_arima` to series of 30 rows and more; Python gets an array and gives back coefficients."""

    def cell(model: dict) -> dict:
        padded = {c: np.r_[model[c], np.zeros(arma.TERMS - len(model[c]))].tolist() for c in ("phi", "theta")}
        return {"const": float(model["const"]), **padded, "sigma2": float(model["sigma2"])}

    def one(y: np.ndarray) -> tuple:
        order, trained = _choose(y[: _ends(len(y))[0]], criterion)
        full = _fit(y, order) or _mean_model(y, order[1])
        return (*order, full["aic"], full["bic"], cell(full), cell(trained))

    @F.pandas_udf(_FIT)
    def fit(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(np.asarray(y, float)) for y in values], columns=["p", "d", "q", "aic", "bic", "whole", "trained"])

    return points.filter(F.size("points") >= MIN_SERIES_ROWS).withColumn("fit", fit(_values("points"))).select("*", "fit.*").drop("fit")


def fit_arima(df: DataFrame, criterion: str = "aic", series: Sequence[str] = SERIES) -> DataFrame:
    """Per series the order that is best on its training part, and the coefficients from the whole series and from that part.

    Coefficients come as arrays of equal length, 0 behind the order. Series under 30 rows give no row.
    """
    return _fitted(_points(df, series), criterion).drop("points")


def apply_arima(
    df: DataFrame, fitted: DataFrame, horizon: int = 30, kinds: Sequence[str] = ("forecast", "fitted", "backtest"), series: Sequence[str] = SERIES
) -> DataFrame:
    """What models with given coefficients (series, p, d, q, aic, bic, whole, trained) make of their series; by kind:

    forecast  h days with the coefficients `whole`, 95 % interval
    fitted    in-sample one-step values of these beside the actual ones
    backtest  one-step values of the test part with the coefficients `trained`, validation left out
    Nothing is below 0. All of it is expressions over one array per series.
    """
    return _applied(_points(df, series).join(fitted, list(series)), horizon, kinds, series)


def _applied(rows: DataFrame, horizon: int, kinds: Sequence[str], series: Sequence[str]) -> DataFrame:
    null = "cast(null as double)"
    low0 = lambda x: f"if({x} < 0, 0D, {x})"

    def cell(kind: str, date: str, actual: str, value: str, low: str = null, high: str = null) -> str:
        return f"named_struct('kind', '{kind}', 'date', {date}, 'actual', {actual}, 'value', {low0(value)}, 'lower_ci', {low0(low)}, 'upper_ci', {low0(high)})"

    cells = []
    rows = rows.withColumn("y", _values("points")).withColumn("w", arma.differences("y", "d"))
    if {"forecast", "fitted"} & set(kinds):
        rows = rows.withColumn("errors", arma.shocks("w", "whole", "q"))
    if "forecast" in kinds:
        rows = rows.withColumn("ahead", arma.ahead("w", "errors", "whole", horizon))
        rows = rows.withColumns({"path": arma.integrated("y", "ahead", "d"), "se": arma.spread_ahead("d", "whole", horizon)})
        made = cell("forecast", "date_add(element_at(points, -1).date, i + 1)", null, "x", f"(x - {Z95}D * se[i + 1])", f"(x + {Z95}D * se[i + 1])")
        cells.append(f"transform(path, (x, i) -> {made})")
    if "fitted" in kinds:
        rows = rows.withColumn("one_step", arma.one_step("y", "d", "errors"))
        cells.append(f"zip_with(points, one_step, (p, x) -> {cell('fitted', 'p.date', 'p.actual', 'x')})")
    if "backtest" in kinds:
        n = F.size("points")
        train_end, val_end = (F.floor(n * F.lit(r)).cast("int") for r in (TRAIN_RATIO, TRAIN_RATIO + VAL_RATIO))
        rows = rows.withColumns({"train_end": train_end, "tested": F.slice("points", val_end + 1, F.greatest(n - val_end, F.lit(0)))})
        rows = rows.withColumn("known", F.concat(F.slice("y", F.lit(1), F.col("train_end")), _values("tested"))).withColumn("known_w", arma.differences("known", "d"))
        rows = rows.withColumn("known_errors", arma.shocks("known_w", "trained", "q")).withColumn("known_step", arma.one_step("known", "d", "known_errors"))
        cells.append(f"zip_with(tested, slice(known_step, train_end + 1, size(tested)), (p, x) -> {cell('backtest', 'p.date', 'p.actual', 'x')})")
    return rows.select(*series, F.expr(f"inline(concat({', '.join(cells)}))"), "p", "d", "q", "aic", "bic")


def arima(
    df: DataFrame,
    horizon: int = 30,
    kinds: Sequence[str] = ("forecast", "fitted", "backtest"),
    criterion: str = "aic",
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Rows as of `apply_arima` with the coefficients of `fit_arima`: only the fit leaves the JVM."""
    return _applied(_fitted(_points(df, series), criterion), horizon, kinds, series)


def arima_forecast(df: DataFrame, horizon: int = 30, series: Sequence[str] = SERIES) -> DataFrame:
    return arima(df, horizon, ("forecast",), series=series).drop("kind", "actual").withColumnRenamed("value", "forecast")


def fitted_vs_actual(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    return arima(df, 1, ("fitted",), series=series).select(*series, "date", F.greatest("actual", F.lit(0.0)).alias("actual"), F.col("value").alias("fitted"))


def backtest_arima(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    return arima(df, 1, ("backtest",), series=series).select(*series, "date", "actual", F.col("value").alias("predicted"))


def _history(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """Training then test rows: backtests step over the validation part."""
    return split_forecast(df, series).filter((F.col("split") != "val") & (F.col("n") >= MIN_SERIES_ROWS))


def backtest_rolling_mean(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """One-step backtest as the autoregressive model is scored: the mean of the last seven known values."""
    last7 = F.avg("sales").over(ordered(series).rowsBetween(-7, -1))
    tested = _history(df, series).withColumn("predicted", clip_low(last7)).filter("split = 'test'")
    return tested.select(*series, "date", F.col("sales").alias("actual"), "predicted")


# Decomposable model: design rows and scoring are Spark expressions, only the solve is numpy.

CHANGEPOINTS, CHANGE_RANGE, YEARLY, WEEKLY = 25, 0.8, 10, 3
CHANGE_SCALE, SEASON_SCALE, HOLIDAY_SCALE, BASE_SCALE = 0.05, 10.0, 10.0, 5.0
_TREND = 2 + CHANGEPOINTS
_YEAR, _WEEK = 2 * YEARLY, 2 * WEEKLY


def _waves(period: float, count: int) -> list[str]:
    return [f"{f}(unix_date(date) * {2 * math.pi * k / period!r}D)" for k in range(1, count + 1) for f in ("sin", "cos")]


# One SQL expression for the whole row: about fifty terms that Spark compiles together.
_HINGES = [f"greatest(0D, t - {CHANGE_RANGE * j / CHANGEPOINTS!r}D)" for j in range(1, CHANGEPOINTS + 1)]
_TERMS = ["1D", "t", *_HINGES, *_waves(365.25, YEARLY), *_waves(7.0, WEEKLY)]
_PROMO_TERM = "cast(coalesce(onpromotion, 0) as double)"


def design_rows(rows: DataFrame, calendar: DataFrame, use_promo: bool = False, series: Sequence[str] = SERIES) -> DataFrame:
    """Adds x (trend, changepoint hinges, yearly and weekly waves, promotion) and the day's holiday names.

    `rows` needs (series, date, sales, learn); time runs from 0 to 1 over the rows to learn from.
    """
    learn = F.when(F.col("learn"), F.col("date"))
    rows = rows.withColumn("first_day", F.min(learn).over(whole(series))).withColumn("last_day", F.max(learn).over(whole(series)))
    x = F.expr(f"array({', '.join([*_TERMS, _PROMO_TERM] if use_promo else _TERMS)})")
    names = holiday_windows(calendar).groupBy("date").agg(F.sort_array(F.collect_set("holiday")).alias("holidays"))
    span = F.greatest(F.datediff("last_day", "first_day"), F.lit(1))
    return (
        rows.withColumn("t", F.datediff("date", "first_day") / span.cast("double"))
        .withColumn("x", x)
        .join(names, "date", "left")
        .withColumn("holidays", F.coalesce("holidays", F.array().cast("array<string>")))
    )


def fit_decomposable(design: DataFrame, multiplicative: bool = True, series: Sequence[str] = SERIES) -> DataFrame:
    """Coefficients per series: beta over x, one effect per holiday name, residual spread.

    Bends have Laplace priors, so the trend bends only where the data ask for it; the rest have normal ones. The multiplicative form is fitted on logarithms, zero sales counting as 0.01.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        y = rows["y"].to_numpy()
        x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
        days = rows["holidays"].to_pylist()
        names = sorted({h for day in days for h in day})
        at = {h: i for i, h in enumerate(names)}
        flags = np.zeros((len(y), len(names)))
        for i, day in enumerate(days):
            flags[i, [at[h] for h in day]] = 1.0
        centre, scale = float(y.mean()), float(y.std()) or 1.0
        scales = np.full(x.shape[1], SEASON_SCALE)
        scales[:2], scales[2:_TREND] = BASE_SCALE, CHANGE_SCALE
        scales = np.r_[scales, np.full(len(names), HOLIDAY_SCALE)]
        beta, spread = solvers.sparse_ridge(np.hstack([x, flags]), (y - centre) / scale, scales, slice(2, _TREND))
        beta = beta * scale
        beta[0] += centre
        found = [[beta[: x.shape[1]].tolist()], [names], [beta[x.shape[1] :].tolist()], [spread * scale]]
        types = [pa.list_(pa.float64()), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()]
        columns = [pa.array([k.as_py()], type=k.type) for k in key] + [pa.array(v, type=t) for v, t in zip(found, types)]
        return pa.table(columns, names=[*series, "beta", "names", "effects", "spread"])

    y = F.log(floor_zero(F.greatest("sales", F.lit(0.0)))) if multiplicative else F.col("sales")
    learned = design.filter("learn").select(*series, "x", "holidays", y.alias("y"))
    schema = key_schema(series) + "beta array<double>, names array<string>, effects array<double>, spread double"
    return learned.groupBy(*series).applyInArrow(run, schema)


def score_decomposable(design: DataFrame, coefficients: DataFrame, multiplicative: bool = True, series: Sequence[str] = SERIES) -> DataFrame:
    """Forecast, 80 % interval and components of each design row; forecast and bounds are not below 0.

    After the last day (t > 1) the trend is taken to bend as often as it may before, each time by the mean size of the past bends and either
    way. A bend at u moves t by (t - u), so over evenly spread bends the variance grows with 2 (t - 1)^3 / 3.
    """

    def dot(start: int, length: int | None = None) -> Column:
        size = F.lit(length) if length is not None else F.greatest(F.size("x") - F.lit(start - 1), F.lit(0))
        pairs = F.zip_with(F.slice("x", F.lit(start), size), F.slice("beta", F.lit(start), size), lambda a, b: a * b)
        return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)

    effect = F.map_from_arrays("names", "effects")
    holidays = F.aggregate(
        F.transform("holidays", lambda h: F.coalesce(F.try_element_at(effect, h), F.lit(0.0))), F.lit(0.0), lambda s, v: s + v
    )
    parts = {
        "trend": dot(1, _TREND),
        "yearly": dot(1 + _TREND, _YEAR),
        "weekly": dot(1 + _TREND + _YEAR, _WEEK),
        "regressor": dot(1 + _TREND + _YEAR + _WEEK),
        "holidays_effect": holidays,
    }
    scored = design.join(coefficients, list(series)).withColumns(parts)
    total = sum((F.col(c) for c in list(parts)[1:]), F.col("trend"))
    bend = F.aggregate(F.slice("beta", 3, CHANGEPOINTS), F.lit(0.0), lambda s, v: s + F.abs(v)) / CHANGEPOINTS
    after = F.greatest(F.col("t") - 1, F.lit(0.0))
    wide = Z80 * F.sqrt(F.col("spread") * F.col("spread") + F.lit(2 * CHANGEPOINTS / 3) * bend * bend * after * after * after)
    shape = F.exp if multiplicative else (lambda c: c)
    component = (lambda c: F.exp(c) - 1) if multiplicative else F.col
    low0 = lambda c: F.greatest(shape(c), F.lit(0.0))
    return scored.withColumn("total", total).select(
        *series,
        "date",
        F.col("sales").alias("actual"),
        low0(F.col("total")).alias("forecast"),
        low0(F.col("total") - wide).alias("lower_ci"),
        low0(F.col("total") + wide).alias("upper_ci"),
        shape(F.col("trend")).alias("trend"),
        component("weekly").alias("weekly"),
        component("yearly").alias("yearly"),
        component("holidays_effect").alias("holidays"),
    )


def _long_enough(df: DataFrame, series: Sequence[str]) -> DataFrame:
    df = spread(df, series).withColumn("n", F.count("*").over(whole(series)))
    return df.filter(F.col("n") >= MIN_SERIES_ROWS).drop("n")


def _with_future(df: DataFrame, horizon: int, planned: DataFrame | None, series: Sequence[str]) -> DataFrame:
    df = _long_enough(df, series)
    spine = future_dates(df, horizon, series)
    has_promo = "onpromotion" in df.columns
    if has_promo and planned is not None:
        spine = future_regressor(spine, planned, series)
    elif has_promo:
        spine = spine.withColumn("onpromotion", F.lit(0).cast("bigint"))
    future = spine.drop("step").withColumn("sales", F.lit(None).cast("double")).withColumn("learn", F.lit(False))
    past = df.select(*series, "date", "sales", *(["onpromotion"] if has_promo else [])).withColumn("learn", F.lit(True))
    return past.unionByName(future)


def decomposable_forecast(
    df: DataFrame,
    calendar: DataFrame,
    horizon: int = 30,
    multiplicative: bool = True,
    use_promo: bool = False,
    planned: DataFrame | None = None,
    series: Sequence[str] = SERIES,
    fitted: DataFrame | None = None,
) -> DataFrame:
    """h days per series with interval and components, fitted on the whole series or with the coefficients in `fitted`."""
    design = design_rows(_with_future(df, horizon, planned if use_promo else None, series), calendar, use_promo, series)
    return score_decomposable(design.filter(~F.col("learn")), fitted or fit_decomposable(design, multiplicative, series), multiplicative, series).drop("actual")


def changepoints(df: DataFrame, calendar: DataFrame, multiplicative: bool = True, series: Sequence[str] = SERIES) -> DataFrame:
    """(series, date, delta): where the trend may bend and by how much, per unit of the series' time span."""
    design = design_rows(_long_enough(df, series).withColumn("learn", F.lit(True)), calendar, series=series)
    return bends(df, fit_decomposable(design, multiplicative, series), series)


def bends(df: DataFrame, fitted: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """The days and sizes of the bends in given coefficients (series, beta)."""
    bounds = df.groupBy(*series).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    bend = F.posexplode(F.slice("beta", 3, CHANGEPOINTS)).alias("pos", "delta")
    offset = F.round(F.datediff("last_day", "first_day") * (F.col("pos") + 1) * F.lit(CHANGE_RANGE / CHANGEPOINTS)).cast("int")
    return fitted.join(bounds, list(series)).select(*series, "first_day", "last_day", bend).select(*series, F.date_add("first_day", offset).alias("date"), "delta")


def backtest_decomposable(
    df: DataFrame,
    calendar: DataFrame,
    multiplicative: bool = True,
    use_promo: bool = False,
    series: Sequence[str] = SERIES,
    fitted: DataFrame | None = None,
) -> DataFrame:
    """Fit on the training part, or take the coefficients in `fitted`, and predict the test days."""
    rows = split_forecast(_long_enough(df, series), series).withColumn("learn", F.col("split") == "train").filter("split != 'val'")
    design = design_rows(rows, calendar, use_promo, series)
    scored = score_decomposable(design.filter(~F.col("learn")), fitted or fit_decomposable(design, multiplicative, series), multiplicative, series)
    return scored.select(*series, "date", "actual", F.col("forecast").alias("predicted"))


# Window model: one linear regression, or one ensemble of trees, over the scaled windows of all series.


def short_series_window(df: DataFrame, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    """The window length a series can carry: shorter than its training and validation parts, 0 when there is none."""
    sizes = split_forecast(df, series).groupBy(*series).agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_val")
    )
    least = F.least("n_train", "n_val")
    used = F.when(least <= 1, 0).when(least <= length, F.greatest(F.lit(1), least - 1)).otherwise(length)
    return sizes.select(*series, "n_train", "n_val", used.cast("int").alias("window"), F.when(least <= 1, "series too short").otherwise("ok").alias("reason"))


def _scaled(df: DataFrame, length: int, series: Sequence[str]) -> DataFrame:
    """Split and scaled rows of the series that can be used, with the window length `used` of each."""
    rows = minmax_train(split_forecast(spread(df, series), series), series)
    train_end, val_end = (F.floor(F.col("n") * F.lit(r)) for r in (TRAIN_RATIO, TRAIN_RATIO + VAL_RATIO))
    rows = rows.withColumn("least", F.least(train_end, val_end - train_end)).filter((F.col("least") > 1) & (F.col("n") >= MIN_SERIES_ROWS))
    used = F.when(F.col("least") <= length, F.greatest(F.lit(1), F.col("least") - 1)).otherwise(F.lit(length))
    return rows.withColumn("used", used.cast("int")).drop("least")


def _padded(past: Column, length: int) -> Column:
    """A shorter window repeats its oldest value in front, so one model serves all lengths."""
    return F.concat(F.array_repeat(F.element_at(past, 1), F.lit(length) - F.size(past)), past)


def _windows(rows: DataFrame, length: int, keys: Sequence[str]) -> DataFrame:
    past = F.collect_list("scaled").over(ordered(keys).rowsBetween(-length, -1))
    rows = rows.withColumn("past", F.slice(past, F.greatest(F.size(past) - F.col("used") + 1, F.lit(1)), F.col("used")))
    return rows.filter(F.size("past") == F.col("used")).withColumn("window", _padded(F.col("past"), length)).drop("past")


def model_windows(df: DataFrame, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    """Training and validation windows; a window never crosses from one part into the other."""
    rows = _scaled(df, length, series).filter(F.col("split") != "test")
    return _windows(rows, length, [*series, "split"]).select(*series, "date", "split", "window", F.col("scaled").alias("label"))


def fit_window_model(windows: DataFrame) -> tuple[list[float], float]:
    """Weights and intercept from the training windows.

    MLlib sums the normal equations over the partitions in one pass; its plain linear estimator would
    take a second one for a summary nobody reads.
    """
    train = windows.filter("split = 'train'").select(array_to_vector("window").alias("features"), "label")
    model = GeneralizedLinearRegression(family="gaussian", link="identity", regParam=1e-4).fit(train)
    return [float(v) for v in model.coefficients], float(model.intercept)


class Trees(NamedTuple):
    """Regression trees as arrays over the nodes of all of them: a window goes left where its value `feature` is at most `threshold`.

    `left` and `right` are places of nodes, both a leaf's own place; `value` is a leaf's; `roots` the trees' first nodes.
    """

    roots: list[int]
    weights: list[float]
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    depth: int


def fit_trees(windows: DataFrame, rounds: int = 20, depth: int = 4, step: float = 0.2) -> Trees:
    """Boosted trees from the training windows; those are added until the loss of the validation windows falls no further.

    MLlib grows each tree level by level over the partitions. The fitted nodes, at most 2^(depth + 1) a tree, become arrays.
    """
    rows = windows.select(array_to_vector("window").alias("features"), "label", (F.col("split") == "val").alias("held"))
    grown = GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=step, validationIndicatorCol="held", validationTol=1e-3, seed=1, cacheNodeIds=False).fit(rows)
    nodes, roots = [], []

    def add(node) -> int:
        at = len(nodes)
        nodes.append([0, 0.0, at, at, float(node.prediction())])
        if node.subtreeDepth() > 0:
            split = node.split()
            nodes[at][:2] = split.featureIndex(), float(split.threshold())
            nodes[at][2] = add(node.leftChild())
            nodes[at][3] = add(node.rightChild())
        return at

    for tree in grown.trees:
        roots.append(add(tree._java_obj.rootNode()))
    return Trees(roots, [float(w) for w in grown.treeWeights], *map(list, zip(*nodes)), max(tree.depth for tree in grown.trees))


def _predict_trees(window: Column, trees: Trees) -> Column:
    """The sum of the trees, each walked from its root as a fold over its levels."""
    at = lambda values, i: F.get(F.array(*map(F.lit, values)), i)
    start = F.arrays_zip(F.array(*map(F.lit, trees.roots)).alias("root"), F.array(*map(F.lit, trees.weights)).alias("weight"))
    down = lambda i, _: F.when(F.get(window, at(trees.feature, i)) <= at(trees.threshold, i), at(trees.left, i)).otherwise(at(trees.right, i))
    leaf = lambda root: F.aggregate(F.array_repeat(F.lit(0), trees.depth), root, down)
    return F.aggregate(start, F.lit(0.0), lambda s, t: s + t["weight"] * at(trees.value, leaf(t["root"])))


def _predict(window: Column, weights: list[float] | Trees, intercept: float = 0.0) -> Column:
    if isinstance(weights, Trees):
        return _predict_trees(window, weights)
    products = F.zip_with(window, F.array(*[F.lit(w) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(intercept)), lambda s, v: s + v)


def window_regression(df: DataFrame, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    """Train the shared model; per part, its loss (mean squared error of scaled values) and window count."""
    windows = model_windows(df, length, series)
    return window_loss(windows, *fit_window_model(windows))


def window_loss(windows: DataFrame, weights: list[float] | Trees, intercept: float = 0.0) -> DataFrame:
    """Per part, the mean squared error of given weights or trees and the number of windows."""
    error = _predict(F.col("window"), weights, intercept) - F.col("label")
    return windows.groupBy("split").agg(F.avg(error * error).alias("loss"), F.count("*").alias("windows"))


def tree_regression(df: DataFrame, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    """Grow the shared trees; per part, their loss, the window count, and the best round, the number of trees kept."""
    windows = model_windows(df, length, series)
    trees = fit_trees(windows)
    return window_loss(windows, trees).withColumn("best_round", F.lit(len(trees.roots)))


def recent_window(df: DataFrame, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    """The last values of the whole series, scaled by its training part, with its last day."""
    rows = _scaled(df, length, series).filter(F.col("n") >= F.col("used")).filter(F.col("rn") > F.col("n") - F.col("used"))
    points = F.sort_array(F.collect_list(F.struct("date", "scaled")))
    last = rows.groupBy(*series).agg(
        points.alias("points"), F.max("date").alias("last_date"), F.first("train_min").alias("train_min"), F.first("train_range").alias("train_range")
    )
    return last.select(*series, "last_date", "train_min", "train_range", F.transform("points", lambda p: p["scaled"]).alias("window"))


def recursive_forecast(
    df: DataFrame, weights: list[float] | Trees, intercept: float = 0.0, horizon: int = 30, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES
) -> DataFrame:
    """h steps, each prediction shifted into the window; not below 0, no interval. One fold per series."""
    start = F.struct(_padded(F.col("window"), length).alias("w"), F.array().cast("array<double>").alias("out"))

    def step(state: Column, _: Column) -> Column:
        nxt = _predict(state["w"], weights, intercept)
        return F.struct(
            F.concat(F.slice(state["w"], 2, length - 1), F.array(nxt)).alias("w"), F.concat(state["out"], F.array(nxt)).alias("out")
        )

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"])
    steps = recent_window(df, length, series).withColumn("path", path)
    rows = steps.select(*series, "last_date", "train_min", "train_range", F.posexplode("path").alias("pos", "scaled"))
    value = F.greatest(minmax_inverse(F.col("scaled")), F.lit(0.0))
    return rows.select(*series, F.date_add("last_date", F.col("pos") + 1).alias("date"), value.alias("forecast"))


def window_forecast(df: DataFrame, horizon: int = 30, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    weights, intercept = fit_window_model(model_windows(df, length, series))
    return recursive_forecast(df, weights, intercept, horizon, length, series)


def tree_forecast(df: DataFrame, horizon: int = 30, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES) -> DataFrame:
    """`window_forecast` with trees grown until the validation part's loss falls no further."""
    return recursive_forecast(df, fit_trees(model_windows(df, length, series)), horizon=horizon, length=length, series=series)


def backtest_window(
    df: DataFrame, weights: list[float] | Trees, intercept: float = 0.0, length: int = WINDOW_LENGTH, series: Sequence[str] = SERIES
) -> DataFrame:
    """One-step predictions of the test part from real history, validation left out."""
    rows = _scaled(df, length, series).filter(F.col("split") != "val")
    tested = _windows(rows, length, series).filter("split = 'test'")
    value = F.greatest(minmax_inverse(_predict(F.col("window"), weights, intercept)), F.lit(0.0))
    return tested.select(*series, "date", F.col("sales").alias("actual"), value.alias("predicted"))


# Results by content.


def series_fingerprint(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """A hash of length, ends and values per series. Row hashes combine map-side in any order."""
    row = F.xxhash64("date", "sales")
    return df.groupBy(*series).agg(
        F.sha2(
            F.concat_ws(
                "|",
                F.count("*").cast("string"),
                F.min("date").cast("string"),
                F.max("date").cast("string"),
                F.bit_xor(row).cast("string"),
                F.sum(row.cast("decimal(20,0)")).cast("string"),
            ),
            256,
        ).alias("fingerprint")
    )


def skip_unchanged(current: DataFrame, stored: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Adds `cache_hit` to the requested (model, series, fingerprint, config) rows.

    A stored result counts only when all of them are equal; the rest is what must be fitted.
    """
    keys = ["model", *series, "fingerprint", "config"]
    known = stored.select(*keys).distinct().withColumn("hit", F.lit(True))
    return current.join(known, keys, "left").withColumn("cache_hit", F.coalesce("hit", F.lit(False))).drop("hit")


def to_fit(current: DataFrame, stored: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    keys = ["model", *series, "fingerprint", "config"]
    return current.join(stored.select(*keys), keys, "left_anti")


def all_forecasts(df: DataFrame, calendar: DataFrame, horizon: int = 30, series: Sequence[str] = SERIES) -> tuple[DataFrame, DataFrame]:
    """(forecasts, backtest pairs) of the three models over every series.

    As in the original scoring, the autoregressive model is judged by its seven-value mean backtest.
    Pass a written panel: five branches read it.
    """
    weights, intercept = fit_window_model(model_windows(df, series=series))
    columns = [*series, "date", "forecast", "lower_ci", "upper_ci"]
    none = F.lit(None).cast("double")
    forecasts = {
        "ARIMA": arima_forecast(df, horizon, series).select(*columns),
        "Prophet": decomposable_forecast(df, calendar, horizon, series=series).select(*columns),
        "LSTM": recursive_forecast(df, weights, intercept, horizon, series=series).select(*series, "date", "forecast", none.alias("lower_ci"), none.alias("upper_ci")),
    }
    backtests = {
        "ARIMA": backtest_rolling_mean(df, series),
        "Prophet": backtest_decomposable(df, calendar, series=series),
        "LSTM": backtest_window(df, weights, intercept, series=series),
    }

    def stack(frames: dict[str, DataFrame]) -> DataFrame:
        out = None
        for model, frame in frames.items():
            frame = frame.withColumn("model", F.lit(model))
            out = frame if out is None else out.unionByName(frame)
        return out

    return stack(forecasts), stack(backtests)


def forecast_all(df: DataFrame, calendar: DataFrame, horizon: int = 30, series: Sequence[str] = SERIES) -> DataFrame:
    """Forecast rows of every model and series with the model's backtest errors, score and rank."""
    forecasts, pairs = all_forecasts(df, calendar, horizon, series)
    ranking = compare_models(compute_all(pairs, ("model", *series)), series).select("model", *series, "rank", "score", "mape", "rmse", "mae")
    return forecasts.join(ranking, ["model", *series], "left")
