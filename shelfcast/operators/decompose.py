"""Per-series tests and decomposition: each series (at most one row per day) is one grouped-map call."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import solvers
from shelfcast.functions.series import ordered, spread
from shelfcast.functions.values import ratio
from shelfcast.schema import MIN_ADF_ROWS, SERIES

_KEY_TYPES = {"family": "string", "store_nbr": "int", "session_id": "string"}


def key_schema(series: Sequence[str]) -> str:
    return "".join(f"{k} {_KEY_TYPES[k]}, " for k in series)


def per_series(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], columns: str, series: Sequence[str] = SERIES) -> DataFrame:
    """Applies `fn` to each series in date order and puts its keys in front of the result."""

    def call(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf.sort_values("date", ignore_index=True))
        for i, (name, value) in enumerate(zip(series, key)):
            out.insert(i, name, value)
        return out

    schema = key_schema(series) + columns
    if not series:
        return df.groupBy().applyInPandas(lambda pdf: fn(pdf.sort_values("date", ignore_index=True)), schema)
    return df.groupBy(*series).applyInPandas(call, schema)


def seasonal_decomposition(df: DataFrame, period: int = 7, series: Sequence[str] = SERIES) -> DataFrame:
    """Observed, trend, seasonal and residual per day of each series; pass series=() for the daily totals.

    Series shorter than two periods or without variation give no rows (see `decomposition_status`).
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf["sales"].ffill().bfill().fillna(0.0).to_numpy(float)
        if len(y) < 2 * period or np.ptp(y) == 0:
            return pd.DataFrame(columns=["date", "observed", "trend", "seasonal", "residual"])
        trend, season = solvers.robust_stl(y, period)
        return pd.DataFrame({"date": pdf["date"], "observed": y, "trend": trend, "seasonal": season, "residual": y - trend - season})

    daily = df.groupBy(*series, "date").agg(F.sum("sales").alias("sales"))
    return per_series(spread(daily, series), run, "date date, observed double, trend double, seasonal double, residual double", series)


def decomposition_status(df: DataFrame, period: int = 7, series: Sequence[str] = SERIES) -> DataFrame:
    """Per series: whether it can be decomposed, and why not."""
    daily = df.groupBy(*series, "date").agg(F.sum("sales").alias("sales"))
    facts = daily.groupBy(*series).agg(F.count("*").alias("days"), (F.max("sales") == F.min("sales")).alias("constant"))
    reason = F.when(F.col("days") < 2 * period, "series too short").when(F.col("constant"), "constant series").otherwise("ok")
    return facts.select(*series, "days", reason.alias("reason"))


def adf_stationarity(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Unit root test per series: statistic, p-value, lags, p < 0.05, suggested d; or the reason there is none."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {"n": len(pdf), "adf_statistic": None, "p_value": None, "used_lag": None, "is_stationary": None, "suggested_d": None, "reason": "ok"}
        if len(pdf) < MIN_ADF_ROWS:
            return pd.DataFrame([{**row, "reason": "series too short"}])
        try:
            stat, p, lag = solvers.adf(pdf["sales"].dropna().to_numpy(float))
        except (ValueError, ZeroDivisionError, np.linalg.LinAlgError) as e:
            return pd.DataFrame([{**row, "reason": str(e)}])
        return pd.DataFrame([{**row, "adf_statistic": stat, "p_value": p, "used_lag": lag, "is_stationary": p < 0.05, "suggested_d": int(p >= 0.05)}])

    columns = "n int, adf_statistic double, p_value double, used_lag int, is_stationary boolean, suggested_d int, reason string"
    return per_series(spread(df.select(*series, "date", "sales"), series), run, columns, series)


def _critical(level: float = 0.05) -> float:
    """The unit root statistic whose p-value is the level."""
    low, high = solvers.TAU_MIN, solvers.TAU_STAR
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if solvers.unit_root_p(middle) < level else (low, middle)
    return low


#: Statistics below it are stationary at 5 %.
TAU_STATIONARY = _critical()


def unit_root_given_lag(df: DataFrame, lag: int = 1, value: str = "sales", series: Sequence[str] = SERIES) -> DataFrame:
    """(series, n, statistic, is_stationary): the unit root test with a constant and a given number of lagged differences.

    Its regression needs only the covariances of the change with the value before it and the changes before it: one map-side
    aggregate, no row leaves the JVM. The lagged changes are eliminated from the covariances one after another; what is left of the
    value before and the change gives slope and standard error. A series that is constant or too short has no statistic.
    """
    w = ordered(series)
    rows = df.filter(F.col(value).isNotNull()).select(*series, F.lag(value).over(w).alias("v0"), (F.col(value) - F.lag(value).over(w)).alias("change"), "date")
    names = ["v0", *(f"v{k}" for k in range(1, lag + 1)), "change"]
    rows = rows.withColumns({f"v{k}": F.lag("change", k).over(w) for k in range(1, lag + 1)}).filter(F.col(f"v{lag}").isNotNull() & F.col("v0").isNotNull())
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    left = rows.groupBy(*series).agg(F.count("*").alias("n"), *[(F.covar_pop(a, b) * F.count("*")).alias(f"{a}_{b}") for a, b in pairs])
    order = {x: i for i, x in enumerate(names)}
    cell = lambda a, b: F.col(f"{a}_{b}" if order[a] <= order[b] else f"{b}_{a}")
    for k in range(1, lag + 1):
        gone, pairs = f"v{k}", [(a, b) for a, b in pairs if f"v{k}" not in (a, b)]
        # A pivot of 0 is a change that the others explain: nothing is left to eliminate.
        left = left.select(*series, "n", *[(cell(a, b) - F.coalesce(ratio(cell(a, gone) * cell(gone, b), cell(gone, gone)), F.lit(0.0))).alias(f"{a}_{b}") for a, b in pairs])
    slope, free = ratio(F.col("v0_change"), F.col("v0_v0")), F.col("n") - (lag + 2)
    error = ratio(F.col("change_change") - slope * F.col("v0_change"), free * F.col("v0_v0"))
    statistic = F.when((free > 0) & (error > 0), ratio(slope, F.sqrt(F.greatest(error, F.lit(0.0)))))
    found = left.select(*series, "n", statistic.alias("statistic"))
    return found.withColumn("is_stationary", F.col("statistic") < TAU_STATIONARY)


def difference_order_given_lag(df: DataFrame, lag: int = 1, series: Sequence[str] = SERIES) -> DataFrame:
    """(series, d) by tests with a given number of lags: 0 if the values are stationary, 1 if their changes are, else 2; 1 without a test."""
    values = unit_root_given_lag(df, lag, "sales", series)
    w = ordered(series)
    steps = df.filter(F.col("sales").isNotNull()).select(*series, "date", (F.col("sales") - F.lag("sales").over(w)).alias("step"))
    changes = unit_root_given_lag(steps, lag, "step", series).select(*series, F.col("is_stationary").alias("step_stationary"))
    d = F.when(F.col("is_stationary"), 0).when(F.col("is_stationary").isNull() | F.col("step_stationary").isNull() | F.col("step_stationary"), 1).otherwise(2)
    return df.select(*series).distinct().join(values, list(series), "left").join(changes, list(series), "left").select(*series, d.alias("d"))


def difference_order(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """How often each series must be differenced: 0, 1 or 2; 1 when the test fails."""
    run = lambda pdf: pd.DataFrame({"d": [solvers.difference_order(pdf["sales"].dropna().to_numpy(float))]})
    return per_series(spread(df.select(*series, "date", "sales"), series), run, "d int", series)
