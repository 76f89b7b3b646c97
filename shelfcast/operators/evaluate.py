"""Forecast errors and model ranking: one row per (model, series), all as aggregates and windows.

`pairs` holds (model, family, store_nbr, date, actual, predicted).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.series import ordered
from shelfcast.functions.values import family_label, finite_or_zero, ratio
from shelfcast.schema import SERIES

ERRORS = ("mae", "rmse", "mape", "smape")
# Weights of the combined score, and the texts that go with a recommendation.
WEIGHTS = {"mape": 0.5, "rmse": 0.3, "mae": 0.2}
REASON = "综合评分最高（MAPE: %.1f%%）"
NOTE = "注：LSTM 为扩展对比模块，在小样本场景下预测精度可能低于统计模型"


def align_pairs(actual: DataFrame, predicted: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Pair by position within the series; the longer side is cut."""
    number = F.row_number().over(ordered(series)).alias("pos")
    left = actual.select(*series, "date", "actual", number)
    right = predicted.select(*series, "predicted", number)
    return left.join(right, [*series, "pos"]).select(*series, "date", "pos", "actual", "predicted")


def _error() -> Column:
    return F.col("actual") - F.col("predicted")


def mae() -> Column:
    return F.avg(F.abs(_error()))


def rmse() -> Column:
    return F.sqrt(F.avg(_error() * _error()))


def mape() -> Column:
    """Zero actuals are skipped; no other actual gives 0."""
    share = F.when(F.abs("actual") > 1e-8, F.abs(_error()) / F.abs("actual"))
    return F.coalesce(F.avg(share) * 100, F.lit(0.0))


def smape() -> Column:
    return F.avg(2 * F.abs(_error()) / (F.abs("actual") + F.abs("predicted") + 1e-8)) * 100


def r2() -> Column:
    """1 - residual / total sum of squares; a constant actual gives 1 when all is hit, else 0."""
    residual, total = F.sum(_error() * _error()), F.var_pop("actual") * F.count("actual")
    return F.when(finite_or_zero(total) == 0, F.when(residual == 0, 1.0).otherwise(0.0)).otherwise(1 - ratio(residual, total))


METRICS = {"mae": mae, "rmse": rmse, "mape": mape, "smape": smape, "r2": r2}


def compute_all(pairs: DataFrame, by: Sequence[str] = ("model", *SERIES), metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """All metrics and the sample size in one aggregate; NaN and infinities become 0."""
    return pairs.groupBy(*by).agg(
        *[finite_or_zero(METRICS[m]()).alias(m) for m in metrics], F.count("*").alias("sample_size")
    )


def _inverted(metric: str, series: Sequence[str]) -> Column:
    """1 for the best model of the series, 0 for the worst, 1 for all when equal."""
    w = Window.partitionBy(*series)
    low, high = F.min(metric).over(w), F.max(metric).over(w)
    return F.when(high == low, 1.0).otherwise(ratio(high - F.col(metric), high - low))


def compare_models(metrics: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Adds the combined score and the rank of each model within its series."""
    w = Window.partitionBy(*series)
    scored = metrics.withColumns({f"{m}_score": _inverted(m, series) for m in WEIGHTS}).withColumn("models", F.count("*").over(w))
    combined = sum((F.lit(k) * F.col(f"{m}_score") for m, k in WEIGHTS.items()), F.lit(0.0))
    scored = scored.withColumn("score", F.when(F.col("models") == 1, 1.0).otherwise(combined))
    order = Window.partitionBy(*series).orderBy(F.desc("score"), "mape", "rmse", "mae", "model")
    return scored.withColumn("rank", F.row_number().over(order)).drop("models", *[f"{m}_score" for m in WEIGHTS])


def radar(metrics: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Long rows (model, series, indicator, value in 0..1)."""
    values = {m: _inverted(m, series) for m in ERRORS}
    values["r2"] = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("r2")))
    cells = F.array(*[F.struct(F.lit(m).alias("indicator"), F.col(f"v_{m}").alias("value")) for m in values])
    return metrics.withColumns({f"v_{m}": c for m, c in values.items()}).select("model", *series, F.inline(cells))


def best_model(ranking: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    reason = F.format_string(REASON, "mape")
    return ranking.filter("rank = 1").select(*series, F.col("model").alias("best_model"), "mape", reason.alias("reason"))


def metric_bars(ranking: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Long rows (series, rank, model, metric, value) in rank order."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mae", "rmse", "mape")])
    return ranking.select(*series, "rank", "model", F.inline(cells))


def actual_vs_predicted(pairs: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Long rows (series, date, name, value): the actual line once, then each model; NULL is 0."""
    first = F.min("model").over(Window.partitionBy(*series, "date")) == F.col("model")
    line = lambda name, c: F.struct(name.alias("name"), finite_or_zero(F.col(c)).alias("value"))
    actual, predicted = line(F.lit("actual"), "actual"), line(F.col("model"), "predicted")
    marked = pairs.withColumn("first", first)
    return marked.select(*series, "date", F.inline(F.when(F.col("first"), F.array(actual, predicted)).otherwise(F.array(predicted))))


def evaluation_report(metrics: DataFrame, horizon: int, series: Sequence[str] = SERIES) -> DataFrame:
    """One row per series: label, horizon, ranked metrics table and recommendation."""
    ranking = compare_models(metrics, series)
    row = F.struct("rank", "model", "mae", "rmse", "mape", "smape", "r2", "score")
    table = ranking.groupBy(*series).agg(F.sort_array(F.collect_list(row)).alias("metrics_table"))
    best = F.col("metrics_table")[0]
    return table.select(
        *series,
        family_label(F.col("family")).alias("label"),
        F.lit(horizon).alias("forecast_days"),
        "metrics_table",
        best["model"].alias("best_model"),
        F.format_string(REASON, best["mape"]).alias("reason"),
        F.lit(NOTE).alias("note"),
    )
