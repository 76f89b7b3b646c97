"""Registered queries: tests, decomposition, forecasts, backtests and their evaluation.

Solvers read a written panel: the source tables are scanned once, however many branches follow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions import arma
from shelfcast.functions.series import ordered, whole
from shelfcast.operators import decompose as dc
from shelfcast.operators import evaluate as ev
from shelfcast.operators import forecast as fc
from shelfcast.operators import results as rs
from shelfcast.operators.features import split_forecast
from shelfcast.plans.rounding import rounded
from shelfcast.plans.sales_queries import forecast_requests
from shelfcast.schema import SERIES
from shelfcast.sources.scratch import scratch_path, snapshot
from shelfcast.sources.tables import calendar, sales_panel

Query = Callable[[SparkSession, str], DataFrame]


def saved_panel(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot(sales_panel(spark, sf), "panel")


def naive_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Actual values of the test part beside three plain predictors: seven-value mean, a week ago, yesterday."""
    w = ordered()
    history = split_forecast(sales_panel(spark, sf)).filter("split <> 'val'")
    rows = history.withColumns(
        {"mean7": F.avg("sales").over(w.rowsBetween(-7, -1)), "week": F.lag("sales", 7).over(w), "day": F.lag("sales", 1).over(w)}
    ).filter("split = 'test' and week is not null")
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("predicted")) for m, c in (("ARIMA", "mean7"), ("Prophet", "week"), ("LSTM", "day"))])
    return rows.select(*SERIES, "date", F.col("sales").alias("actual"), F.inline(models))


def _metrics(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    return ev.compute_all(naive_pairs(spark, sf), metrics=names or tuple(ev.METRICS))


def _ranking(spark: SparkSession, sf: str) -> DataFrame:
    return ev.compare_models(_metrics(spark, sf))


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    """The test part against predictions that stop three values early."""
    tested = fc.backtest_rolling_mean(sales_panel(spark, sf))
    back = F.row_number().over(ordered().orderBy(F.desc("date")))
    predicted = tested.withColumn("back", back).filter("back > 3")
    return ev.align_pairs(tested, predicted.select(*SERIES, "date", "predicted"))


def _cache(spark: SparkSession, sf: str) -> DataFrame:
    """Stored results know store 2 only up to 2000 and no current LSTM configuration."""
    panel = sales_panel(spark, sf)

    def keyed(df: DataFrame, lstm: str) -> DataFrame:
        config = F.when(F.col("model") == "LSTM", lstm).otherwise("{}")
        models = F.explode(F.array(F.lit("ARIMA"), F.lit("Prophet"), F.lit("LSTM"))).alias("model")
        return fc.series_fingerprint(df).select(models, *SERIES, "fingerprint").withColumn("config", config)

    stored = keyed(panel.filter((F.col("store_nbr") != 2) | (F.col("date") < "2001-01-01")), '{"seq_len":7}')
    return fc.skip_unchanged(keyed(panel, '{"seq_len":30}'), stored).select("model", *SERIES, "cache_hit")


def _answered(spark: SparkSession, sf: str) -> DataFrame:
    """Per request and model: rows and days of the forecast; or why the request was refused."""
    answers = rs.answer_requests(forecast_requests(spark, sf), saved_panel(spark, sf), calendar(spark), scratch_path(spark, "store"))
    facts = answers.forecasts.groupBy("request_id", "model").agg(
        F.count("*").alias("rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count_if(F.col("forecast") < 0).alias("negative")
    )
    return answers.status.join(facts, "request_id", "left").select("request_id", "reason", "model", "rows", "first_day", "last_day", "negative")


def _ranked_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Errors and ranks that requests for the autoregressive model get; SQL can state its backtest."""
    panel = saved_panel(spark, sf)
    asked = rs.request_everything(panel, 14, ("ARIMA",))
    ranking = rs.answer_requests(asked, panel, calendar(spark), scratch_path(spark, "store")).ranking
    return rounded(ranking.select(*SERIES, "model", *ev.METRICS, "sample_size", "score", "rank"))


def _reused(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs on one store: all series, the same again, and with one changed value; hits, rows, and whether rows that were served again are equal."""
    store, panel = scratch_path(spark, "store"), saved_panel(spark, sf)
    last = F.col("date") == F.max("date").over(whole())
    one = (F.col("store_nbr") == 2) & (F.col("family") == "PROMO") & last
    changed = snapshot(panel.withColumn("sales", F.when(one, F.col("sales") + 1).otherwise(F.col("sales"))), "panel")
    out = None
    for i, (given, horizon) in enumerate(((panel, 14), (panel, 30), (changed, 14)), 1):
        served = rs.answer_requests(rs.request_everything(given, horizon), given, calendar(spark), store).forecasts
        content = F.bit_xor(F.when(F.datediff("date", "start") < 14, F.xxhash64("date", "forecast", "lower_ci", "upper_ci"))).alias(f"content{i}")
        facts = served.withColumn("start", F.min("date").over(Window.partitionBy("model", *SERIES))).groupBy("model", *SERIES).agg(
            F.bool_and("cache_hit").alias(f"hit{i}"), F.count("*").alias(f"rows{i}"), content
        )
        facts = snapshot(facts, "served")
        out = facts if out is None else out.join(facts, ["model", *SERIES])
    same = lambda i: (F.col(f"content{i}") == F.col("content1")).alias(f"same{i}")
    return out.select("model", *SERIES, "hit1", "hit2", "hit3", "rows1", "rows2", "rows3", same(2), (same(3) | ~F.col("hit3")).alias("same3"))


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    df = fc.recent_window(sales_panel(spark, sf))
    return rounded(
        df.select(
            *SERIES, "last_date", F.size("window").alias("size"), F.element_at("window", 1).alias("oldest"), F.element_at("window", -1).alias("newest"),
            F.aggregate("window", F.lit(0.0), lambda a, x: a + x).alias("window_sum"),
        )
    )


def _window_backtest(spark: SparkSession, sf: str) -> DataFrame:
    df = saved_panel(spark, sf)
    return fc.backtest_window(df, *fc.fit_window_model(fc.model_windows(df)))


#: Given weights of seven days, so that SQL can state what the window model makes of them.
GIVEN_WEIGHTS, GIVEN_INTERCEPT = [0.05, 0.05, 0.1, 0.1, 0.1, 0.2, 0.3], 0.01


#: Given trees over the same windows: one of two splits and one of a single split, which counts half.
GIVEN_TREES = fc.Trees([0, 5], [1.0, 0.5], [6, 0, 0, 0, 0, 3, 0, 0], [0.4037, 0, 0.2519, 0, 0, 0.3571, 0, 0], [1, 1, 3, 3, 4, 6, 6, 7], [2, 1, 4, 3, 4, 7, 6, 7], [0, 0.31, 0, 0.52, 0.83, 0, -0.05, 0.11], 2)


def _given_recursion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fc.recursive_forecast(sales_panel(spark, sf), GIVEN_WEIGHTS, GIVEN_INTERCEPT, horizon=10, length=7))


def _given_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fc.backtest_window(sales_panel(spark, sf), GIVEN_WEIGHTS, GIVEN_INTERCEPT, length=7))


#: Given coefficients by the number of differences: stores with odd numbers are taken as they are, the others differenced once.
GIVEN_PHI, GIVEN_THETA, GIVEN_CONST, GIVEN_SIGMA2 = (0.4137, 0.1993), (0.3071, -0.2113), {0: 2.0173, 1: 0.1013}, 9.0


def _given_arima(kind: str, horizon: int = 10) -> Query:
    """Rows of one kind from an autoregressive moving-average model with given coefficients."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        panel = saved_panel(spark, sf)
        listed = lambda c: F.array(*map(F.lit, (*c, *[0.0] * (arma.TERMS - len(c)))))
        d = F.when(F.col("store_nbr") % 2 == 1, 0).otherwise(1)
        const = F.when(d == 0, GIVEN_CONST[0]).otherwise(GIVEN_CONST[1])
        model = F.struct(const.alias("const"), listed(GIVEN_PHI).alias("phi"), listed(GIVEN_THETA).alias("theta"), F.lit(GIVEN_SIGMA2).alias("sigma2"))
        none = F.lit(None).cast("double")
        series = fc.forecast_status(panel).filter("reason = 'ok'")
        given = series.select(*SERIES, F.lit(2).alias("p"), d.alias("d"), F.lit(2).alias("q"), none.alias("aic"), none.alias("bic"), model.alias("whole"), model.alias("trained"))
        rows = fc.apply_arima(panel, given, horizon, (kind,))
        return rounded(rows.select(*SERIES, "date", *(["value", "lower_ci", "upper_ci"] if kind == "forecast" else ["actual", "value"])))

    return run


#: Given coefficients of the decomposable model over its design row, effects of holiday names, and spread.
GIVEN_BETA = [3.1, 0.4, *(0.05 * (-1) ** j / j for j in range(1, fc.CHANGEPOINTS + 1)), *(0.21 / (k + 2) for k in range(2 * fc.YEARLY)), *(0.07 * (-1) ** k / (k + 1) for k in range(2 * fc.WEEKLY))]
GIVEN_EFFECTS, GIVEN_SPREAD = {"Xmas": 0.6, "Fair": -0.4, "Town day": 0.25}, 0.3


def _given_coefficients(panel: DataFrame) -> DataFrame:
    listed = lambda values: F.array(*map(F.lit, values))
    return panel.select(*SERIES).distinct().select(
        *SERIES, listed(GIVEN_BETA).alias("beta"), listed(GIVEN_EFFECTS).alias("names"), listed(GIVEN_EFFECTS.values()).alias("effects"), F.lit(GIVEN_SPREAD).alias("spread")
    )


def _given_decomposable(spark: SparkSession, sf: str) -> DataFrame:
    """Ten days ahead with bounds and components."""
    panel = saved_panel(spark, sf)
    return rounded(fc.decomposable_forecast(panel, calendar(spark), 10, fitted=_given_coefficients(panel)))


def _given_decomposable_history(spark: SparkSession, sf: str) -> DataFrame:
    """The additive form over the history, with the days of events."""
    panel = saved_panel(spark, sf)
    design = fc.design_rows(panel.withColumn("learn", F.lit(True)), calendar(spark))
    scored = fc.score_decomposable(design, _given_coefficients(panel), multiplicative=False)
    return rounded(scored.select(*SERIES, "date", "actual", "forecast", "holidays", "weekly"))


def _given_decomposable_backtest(spark: SparkSession, sf: str) -> DataFrame:
    panel = saved_panel(spark, sf)
    return rounded(fc.backtest_decomposable(panel, calendar(spark), fitted=_given_coefficients(panel)))


def _given_bends(spark: SparkSession, sf: str) -> DataFrame:
    panel = saved_panel(spark, sf)
    return rounded(fc.bends(panel, _given_coefficients(panel)))


def _tree_recursion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fc.recursive_forecast(sales_panel(spark, sf), GIVEN_TREES, horizon=10, length=7))


def _tree_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fc.backtest_window(sales_panel(spark, sf), GIVEN_TREES, length=7))


def _tree_loss(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fc.window_loss(fc.model_windows(sales_panel(spark, sf), 7), GIVEN_TREES))


def _given_loss(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fc.window_loss(fc.model_windows(sales_panel(spark, sf), 7), GIVEN_WEIGHTS, GIVEN_INTERCEPT))


def _forecast_shape(forecasts: DataFrame, panel: DataFrame) -> DataFrame:
    """Per series: number of rows, first day after the history, gaps between days, rows out of bounds."""
    last = panel.groupBy(*SERIES).agg(F.max("date").alias("last"))
    low, high = (F.coalesce(c, F.col("forecast")) for c in ("lower_ci", "upper_ci"))
    odd = (low < 0) | (low > F.col("forecast")) | (high < F.col("forecast")) | F.col("forecast").isNull() | F.isnan("forecast")
    facts = forecasts.groupBy(*SERIES).agg(
        F.count("*").alias("rows"), F.count_distinct("date").alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count_if(odd).alias("odd")
    )
    return facts.join(last, list(SERIES)).select(
        *SERIES, "rows", "days", F.datediff("first_day", "last").alias("starts_after"), F.datediff("last_day", "first_day").alias("span"), "odd"
    )


def _shape(fit: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        panel = saved_panel(spark, sf)
        return _forecast_shape(fit(spark, panel), panel)

    return run


def _backtest_shape(backtest: DataFrame) -> DataFrame:
    """Per series: tested days, sum of the actual values, predictions that are missing or below 0."""
    odd = F.col("predicted").isNull() | F.isnan("predicted") | (F.col("predicted") < 0)
    return rounded(backtest.groupBy(*SERIES).agg(F.count("*").alias("rows"), F.min("date").alias("first_day"), F.sum("actual").alias("actual"), F.count_if(odd).alias("odd")))


def _decomposition_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Per series: days, sum of the observed values, days whose parts do not add up to them."""
    parts = dc.seasonal_decomposition(sales_panel(spark, sf))
    gap = F.abs(F.col("observed") - F.col("trend") - F.col("seasonal") - F.col("residual"))
    return rounded(parts.groupBy(*SERIES).agg(F.count("*").alias("rows"), F.sum("observed").alias("observed"), F.count_if(~(gap <= 1e-6 * (1 + F.abs("observed")))).alias("odd")))


def _fitted_shape(spark: SparkSession, sf: str) -> DataFrame:
    fitted = fc.fitted_vs_actual(sales_panel(spark, sf))
    odd = F.col("fitted").isNull() | F.isnan("fitted") | (F.col("fitted") < 0)
    return rounded(fitted.groupBy(*SERIES).agg(F.count("*").alias("rows"), F.sum("actual").alias("actual"), F.count_if(odd).alias("odd")))


def _orders_in_range(spark: SparkSession, sf: str) -> DataFrame:
    found = fc.order_search(sales_panel(spark, sf))
    fits = F.col("p").between(0, 3) & F.col("d").between(0, 2) & F.col("q").between(0, 3)
    return found.select(*SERIES, fits.alias("in_range"))


def _fingerprint_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each series has the same fingerprint after rows are dealt anew, and another one after a change of one value."""
    panel = sales_panel(spark, sf)
    same = fc.series_fingerprint(panel.repartition(7, "date")).withColumnRenamed("fingerprint", "same")
    last = F.row_number().over(ordered().orderBy(F.desc("date"))) == 1
    changed = panel.withColumn("last", last).withColumn("sales", F.when(F.col("last") & (F.col("store_nbr") % 2 == 1), F.col("sales") + 1).otherwise(F.col("sales")))
    other = fc.series_fingerprint(changed.drop("last")).withColumnRenamed("fingerprint", "other")
    both = fc.series_fingerprint(panel).join(same, list(SERIES)).join(other, list(SERIES))
    return both.select(*SERIES, (F.col("fingerprint") == F.col("same")).alias("stable"), (F.col("fingerprint") != F.col("other")).alias("changed"))


def _adf_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per series: days, and whether p-value, verdict and suggested order agree with each other."""
    found = dc.adf_stationarity(sales_panel(spark, sf))
    agree = F.col("p_value").between(0, 1) & (F.col("is_stationary") == (F.col("p_value") < 0.05)) & (F.col("suggested_d") == F.when(F.col("is_stationary"), 0).otherwise(1))
    return found.select(*SERIES, "n", "reason", F.coalesce(agree, F.lit(False)).alias("agree"))


def _evaluation(spark: SparkSession, sf: str) -> DataFrame:
    report = ev.evaluation_report(_metrics(spark, sf), 30)
    return report.select(
        *SERIES, "label", "forecast_days", F.size("metrics_table").alias("models"), "best_model",
        F.round(F.col("metrics_table")[0]["mape"], 6).alias("best_mape"), F.round(F.element_at("metrics_table", -1)["score"], 6).alias("last_score"),
    )


QUERIES: dict[str, Query] = {
    "seasonal_decomposition": lambda s, d: dc.seasonal_decomposition(sales_panel(s, d)),
    "seasonal_decomposition_total": lambda s, d: dc.seasonal_decomposition(sales_panel(s, d), series=()),
    "decomposition_status": lambda s, d: dc.decomposition_status(sales_panel(s, d)),
    "adf_stationarity": lambda s, d: dc.adf_stationarity(sales_panel(s, d)),
    "difference_order": lambda s, d: dc.difference_order(sales_panel(s, d)),
    "order_search": lambda s, d: fc.order_search(saved_panel(s, d)),
    "arima_forecast": lambda s, d: fc.arima_forecast(sales_panel(s, d)),
    "fitted_vs_actual": lambda s, d: fc.fitted_vs_actual(sales_panel(s, d)),
    "backtest_rolling_mean": lambda s, d: rounded(fc.backtest_rolling_mean(sales_panel(s, d))),
    "backtest_arima": lambda s, d: fc.backtest_arima(sales_panel(s, d)),
    "decomposable_forecast": lambda s, d: fc.decomposable_forecast(saved_panel(s, d), calendar(s)),
    "decomposable_forecast_promo": lambda s, d: fc.decomposable_forecast(saved_panel(s, d), calendar(s), use_promo=True),
    "changepoints": lambda s, d: fc.changepoints(saved_panel(s, d), calendar(s)),
    "backtest_decomposable": lambda s, d: fc.backtest_decomposable(saved_panel(s, d), calendar(s)),
    "forecast_status": lambda s, d: fc.forecast_status(sales_panel(s, d)),
    "arima_forecast_shape": _shape(lambda s, p: fc.arima_forecast(p)),
    "decomposable_forecast_shape": _shape(lambda s, p: fc.decomposable_forecast(p, calendar(s))),
    "window_forecast_shape": _shape(lambda s, p: fc.window_forecast(p).withColumns({c: F.lit(None).cast("double") for c in ("lower_ci", "upper_ci")})),
    "backtest_arima_shape": lambda s, d: _backtest_shape(fc.backtest_arima(sales_panel(s, d))),
    "backtest_decomposable_shape": lambda s, d: _backtest_shape(fc.backtest_decomposable(saved_panel(s, d), calendar(s))),
    "recursive_forecast_given": _given_recursion,
    "backtest_window_given": _given_backtest,
    "unit_root_lag0": lambda s, d: rounded(dc.unit_root_given_lag(sales_panel(s, d), 0)),
    "unit_root_lag1": lambda s, d: rounded(dc.unit_root_given_lag(sales_panel(s, d), 1)),
    "difference_order_lag1": lambda s, d: dc.difference_order_given_lag(saved_panel(s, d), 1),
    "decomposable_given": _given_decomposable,
    "decomposable_history_given": _given_decomposable_history,
    "backtest_decomposable_given": _given_decomposable_backtest,
    "changepoints_given": _given_bends,
    "window_loss_given": _given_loss,
    "tree_loss_given": _tree_loss,
    "tree_recursion_given": _tree_recursion,
    "tree_backtest_given": _tree_backtest,
    "arima_given": _given_arima("forecast"),
    "fitted_given": _given_arima("fitted"),
    "backtest_arima_given": _given_arima("backtest"),
    "seasonal_decomposition_sums": _decomposition_sums,
    "fitted_vs_actual_shape": _fitted_shape,
    "order_search_range": _orders_in_range,
    "adf_stationarity_rows": _adf_rows,
    "series_fingerprint_classes": _fingerprint_classes,
    "window_regression": lambda s, d: fc.window_regression(saved_panel(s, d)),
    "recursive_forecast": lambda s, d: fc.window_forecast(saved_panel(s, d)),
    "tree_regression": lambda s, d: fc.tree_regression(saved_panel(s, d)),
    "tree_forecast": lambda s, d: fc.tree_forecast(saved_panel(s, d)),
    "backtest_window": _window_backtest,
    "recent_window": _recent,
    "short_series_window": lambda s, d: fc.short_series_window(sales_panel(s, d), length=60),
    "series_fingerprint": lambda s, d: fc.series_fingerprint(sales_panel(s, d)),
    "skip_unchanged": _cache,
    "forecast_by_request": _answered,
    "request_ranking": _ranked_requests,
    "results_reuse": _reused,
    "forecast_all": lambda s, d: fc.forecast_all(saved_panel(s, d), calendar(s)),
    # evaluation
    "align_pairs": lambda s, d: rounded(_aligned(s, d)),
    "mae": lambda s, d: rounded(_metrics(s, d, "mae")),
    "rmse": lambda s, d: rounded(_metrics(s, d, "rmse")),
    "mape": lambda s, d: rounded(_metrics(s, d, "mape")),
    "smape": lambda s, d: rounded(_metrics(s, d, "smape")),
    "r2": lambda s, d: rounded(_metrics(s, d, "r2")),
    "compute_all": lambda s, d: rounded(_metrics(s, d)),
    "compare_models": lambda s, d: rounded(_ranking(s, d)),
    "radar": lambda s, d: rounded(ev.radar(_metrics(s, d)), offset=1e-8),
    "best_model": lambda s, d: rounded(ev.best_model(_ranking(s, d)).drop("reason")),
    "metric_bars": lambda s, d: rounded(ev.metric_bars(_ranking(s, d))),
    "actual_vs_predicted": lambda s, d: rounded(ev.actual_vs_predicted(naive_pairs(s, d))),
    "evaluation_report": _evaluation,
}
