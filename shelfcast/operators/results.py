"""Forecasts by request, served from a table of stored results.

A result is what one model makes of one series: its path over the longest horizon, its backtest and its errors. It is keyed by the
model, the series, the fingerprint of the series' rows and the model's settings. Requests name series, models, settings and a horizon;
the keys they need are looked up, only those that the table lacks are fitted, once for however many requests, and each request gets
its part of the paths.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import forecast as fc
from shelfcast.operators.evaluate import METRICS, actual_vs_predicted, compare_models, compute_all
from shelfcast.operators.validate import forecast_request_check
from shelfcast.schema import HORIZON_RANGE, MODELS, SERIES, WINDOW_LENGTH
from shelfcast.sources.scratch import snapshot

KEYS = ("model", *SERIES, "fingerprint", "config")
#: The setting that each model knows, and its default.
SETTINGS = {"ARIMA": ("criterion", "aic"), "Prophet": ("seasonality_mode", "multiplicative"), "LSTM": ("seq_len", str(WINDOW_LENGTH))}
CHOICES = {"criterion": ("aic", "bic"), "seasonality_mode": ("multiplicative", "additive")}
LONGEST_WINDOW = 90

_POINT = "array<struct<date: date, forecast: double, lower_ci: double, upper_ci: double>>"
_PAIR = "array<struct<date: date, actual: double, predicted: double>>"
_ERRORS = ", ".join(f"{m} double" for m in METRICS)
RESULT_SCHEMA = f"family string, store_nbr int, fingerprint string, config string, path {_POINT}, backtest {_PAIR}, {_ERRORS}, sample_size long, model string, run string"


def settings(model: Column, given: Column) -> Column:
    """The settings of a model as JSON in one spelling, with defaults; NULL for a value the model does not know."""
    out = F.lit(None).cast("string")
    for name, (key, default) in SETTINGS.items():
        value = F.coalesce(F.get_json_object(given, f"$.{key}"), F.lit(default))
        known = value.isin(*CHOICES[key]) if key in CHOICES else value.try_cast("int").between(2, LONGEST_WINDOW)
        out = F.when((model == name) & known, F.to_json(F.struct(value.alias(key)))).otherwise(out)
    return out


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All stored results; empty when nothing was stored yet. Equal keys, of writers at the same time, count once."""
    try:
        found = spark.read.schema(RESULT_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RESULT_SCHEMA)
    return found.dropDuplicates(list(KEYS))


def fit_model(model: str, config: str, panel: DataFrame, calendar: DataFrame, wanted: DataFrame, horizon: int) -> tuple[DataFrame, DataFrame]:
    """(forecasts, backtest pairs) of one model with one setting for the wanted series.

    The window model is one for all series: it learns from the whole panel and is applied to the wanted part.
    """
    part = panel.join(wanted.select(*SERIES), list(SERIES), "left_semi")
    value = json.loads(config)[SETTINGS[model][0]]
    none = F.lit(None).cast("double")
    if model == "ARIMA":
        path = fc.arima(part, horizon, ("forecast",), value).withColumnRenamed("value", "forecast")
        return path, fc.backtest_rolling_mean(part)
    if model == "Prophet":
        multiplicative = value == "multiplicative"
        return fc.decomposable_forecast(part, calendar, horizon, multiplicative), fc.backtest_decomposable(part, calendar, multiplicative)
    length = int(value)
    weights, intercept = fc.fit_window_model(fc.model_windows(panel, length))
    path = fc.recursive_forecast(part, weights, intercept, horizon, length)
    return path.withColumns({"lower_ci": none, "upper_ci": none}), fc.backtest_window(part, weights, intercept, length)


def _result_rows(wanted: DataFrame, forecasts: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per wanted key: path and backtest as arrays by date, and the errors of the backtest."""
    path = forecasts.groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct("date", "forecast", "lower_ci", "upper_ci"))).alias("path"))
    tested = pairs.groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct("date", "actual", "predicted"))).alias("backtest"))
    errors = compute_all(pairs, SERIES)
    return wanted.join(path, list(SERIES)).join(tested, list(SERIES)).join(errors, list(SERIES))


def ensure_results(wanted: DataFrame, panel: DataFrame, calendar: DataFrame, store: str, horizon: int = HORIZON_RANGE[1]) -> DataFrame:
    """The stored result of each wanted key (model, series, fingerprint, config), with `cache_hit`.

    Keys that are not stored are fitted, by model and setting, and written to a partition named after that very set of keys: a run
    that is repeated after a failure writes the same partition again instead of a second copy. Nothing is fitted without new keys.
    """
    spark = wanted.sparkSession
    flagged = snapshot(fc.skip_unchanged(wanted, read_results(spark, store)).withColumn("mark", F.xxhash64(*KEYS)), "wanted")
    new = flagged.filter("not cache_hit")
    for model, config, n, mark in new.groupBy("model", "config").agg(F.count("*"), F.bit_xor("mark")).orderBy("model", "config").collect():
        todo = new.filter((F.col("model") == model) & (F.col("config") == config)).select(*KEYS)
        rows = _result_rows(todo, *fit_model(model, config, panel, calendar, todo, horizon))
        named = rows.withColumn("run", F.lit(f"{n}-{mark & (1 << 64) - 1:016x}"))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "run").parquet(store)
    return flagged.drop("mark").join(read_results(spark, store).drop("run"), list(KEYS))


class Answers(NamedTuple):
    """What requests get: each one's status; forecasts, ranking and test chart of the accepted ones."""

    status: DataFrame
    forecasts: DataFrame
    ranking: DataFrame
    chart: DataFrame


def answer_requests(requests: DataFrame, panel: DataFrame, calendar: DataFrame, store: str) -> Answers:
    """Answers to requests (request_id, family, store_nbr, horizon, models[, configs]); request_id is unique.

    `configs` maps a model to its settings as JSON. A refused request has a reason in `status` and rows in nothing else. Pass a written
    panel: each model reads it.
    """
    spark = requests.sparkSession
    given = F.col("configs") if "configs" in requests.columns else F.create_map().cast("map<string,string>")
    models = F.explode_outer(F.array_distinct("models")).alias("model")
    asked = requests.select("request_id", *SERIES, "horizon", given.alias("configs"), models)
    asked = asked.withColumn("config", settings(F.col("model"), F.try_element_at("configs", F.col("model")))).drop("configs")
    odd = asked.filter(F.col("model").isin(*MODELS) & F.col("config").isNull()).select("request_id").distinct().withColumn("odd", F.lit(True))
    checked = forecast_request_check(requests.select("request_id", *SERIES, "horizon", "models"), panel).join(odd, "request_id", "left")
    fine = F.col("ok") & F.col("odd").isNull()
    reason = F.when(F.col("ok") & F.col("odd"), "setting not supported").otherwise(F.col("reason"))
    status = snapshot(checked.select("request_id", fine.alias("ok"), reason.alias("reason")), "status")

    accepted = snapshot(asked.join(status.filter("ok"), "request_id", "left_semi"), "asked")
    series = accepted.select(*SERIES).distinct()
    prints = fc.series_fingerprint(panel.join(series, list(SERIES), "left_semi"))
    wanted = accepted.select("model", *SERIES, "config").distinct().join(prints, list(SERIES)).select(*KEYS)
    results = snapshot(ensure_results(wanted, panel, calendar, store), "results")

    # One fingerprint a series, so model, series and settings find a result.
    served = accepted.join(results, ["model", *SERIES, "config"])
    points = F.inline(F.slice("path", F.lit(1), F.col("horizon")))
    forecasts = served.select("request_id", "model", *SERIES, "cache_hit", points)
    ranking = compare_models(served.select("request_id", "model", *SERIES, *METRICS, "sample_size"), ("request_id",))
    pairs = served.select("request_id", "model", F.inline("backtest"))
    return Answers(status, forecasts, ranking, actual_vs_predicted(pairs, ("request_id",)))


def request_everything(panel: DataFrame, horizon: int, models: Sequence[str] = MODELS) -> DataFrame:
    """One request per series that is long enough, for all models."""
    series = fc.forecast_status(panel).filter("reason = 'ok'").select(*SERIES)
    number = F.xxhash64(*SERIES).alias("request_id")
    return series.select(number, *SERIES, F.lit(horizon).alias("horizon"), F.array(*map(F.lit, models)).alias("models"))
