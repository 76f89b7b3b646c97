"""Registered queries: validation, cleaning, features, totals and analyses over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.values import family_label, finite_or_null, finite_or_zero, safe_key
from shelfcast.operators import aggregate as agg
from shelfcast.operators import analysis as an
from shelfcast.operators import clean as cl
from shelfcast.operators import features as ft
from shelfcast.operators import validate as va
from shelfcast.plans.rounding import rounded
from shelfcast.schema import DAILY_TREND_LIMIT, SERIES
from shelfcast.sources.scratch import snapshot
from shelfcast.sources.tables import calendar, order_calendar, raw_sales, raw_text, sales_panel, table

Query = Callable[[SparkSession, str], DataFrame]


def gapped(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sales with unique keys and their gaps kept."""
    return cl.clip_negative(cl.merge_duplicates(raw_sales(spark, sf), keep_missing=True))


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return cl.clip_negative(cl.merge_duplicates(raw_sales(spark, sf)))


def promo_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Unique rows whose promotion is missing in the first half of each month."""
    promo = F.when(F.dayofmonth("date") > 15, F.col("onpromotion"))
    return sales_panel(spark, sf).withColumn("onpromotion", promo)


def forecast_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per customer; keys, horizons and models go out of range on purpose."""
    key = F.col("c_custkey")
    pick = lambda n, *names: F.element_at(F.array(*[F.lit(x) for x in names]), (key % n + 1).cast("int"))
    return table(spark, sf, "customer").select(
        key.alias("request_id"),
        pick(8, "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "GARDEN", None).alias("family"),
        F.col("c_nationkey").cast("int").alias("store_nbr"),
        (key % 100).cast("int").alias("horizon"),
        F.when(key % 11 == 0, F.array().cast("array<string>"))
        .when(key % 13 == 0, F.array(F.lit("ARIMA"), F.lit("Other")))
        .otherwise(F.array(F.lit("ARIMA"), F.lit("Prophet")))
        .alias("models"),
    )


def _spikes(spark: SparkSession, sf: str) -> DataFrame:
    return cl.replace_spikes(cl.flag_events(merged(spark, sf), calendar(spark)))


def _ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Promotion ratios with NaN and infinity in them, and both ways to make them safe."""
    promo = F.col("onpromotion").cast("double")
    value = F.when(promo == 0, F.lit(float("nan"))).when(promo > 3, F.lit(float("inf"))).otherwise(F.col("sales") / promo)
    df = sales_panel(spark, sf).withColumn("value", value)
    return df.select(
        "date", "family", "store_nbr",
        F.round(finite_or_null(F.col("value")), 6).alias("as_null"),
        F.round(finite_or_zero(F.col("value")), 6).alias("as_zero"),
    )


def _summary_flat(spark: SparkSession, sf: str) -> DataFrame:
    return agg.dataset_summary(_spikes(spark, sf)).select(
        "total_rows", "start", "end", "days", "family_count", "store_count", "missing_after", "outliers_replaced", "outliers_kept",
        F.array_join(F.transform("families", lambda f: f["name"]), ",").alias("family_names"),
        F.aggregate("families", F.lit(0.0), lambda a, f: a + f["total_sales"]).alias("total_sales"),
        F.array_join(F.transform("stores", lambda s: s.cast("string")), ",").alias("store_list"),
    )


def _windows_flat(spark: SparkSession, sf: str) -> DataFrame:
    df = ft.sliding_windows(sales_panel(spark, sf))
    total = F.aggregate("window", F.lit(0.0), lambda a, x: a + x)
    return df.select("family", "store_nbr", "date", "label", F.element_at("window", 1).alias("oldest"), F.element_at("window", -1).alias("newest"), total.alias("window_sum"))


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    """The last ten days' promotions as the plan for the first ten future days."""
    df = ft._numbered(sales_panel(spark, sf), SERIES)
    return df.filter(F.col("rn") > F.col("n") - 10).select(*SERIES, (F.col("rn") - F.col("n") + 10).cast("int").alias("step"), "onpromotion")


def _regressor(spark: SparkSession, sf: str) -> DataFrame:
    """Promotions known on even days only."""
    return sales_panel(spark, sf).filter(F.dayofmonth("date") % 2 == 0)


def _series_points(spark: SparkSession, sf: str) -> DataFrame:
    df = agg.by_family_store(sales_panel(spark, sf))
    return df.select(
        *SERIES,
        F.size("points").alias("n"),
        F.col("points")[0]["date"].alias("first_date"),
        F.element_at("points", -1)["date"].alias("last_date"),
        F.element_at("points", -1)["sales"].alias("last_sales"),
        F.aggregate("points", F.lit(0.0), lambda a, p: a + p["sales"]).alias("total_sales"),
    )


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(an.analysis_report(snapshot(sales_panel(spark, sf), "panel")))


def _monthly_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = an.monthly_comparison(sales_panel(spark, sf))
    return wide.select("month", *[F.col(c).alias(f"y{c}") for c in wide.columns if c != "month"])


KEYS = ("date", "family", "store_nbr")

QUERIES: dict[str, Query] = {
    # selection and validation
    "panel": sales_panel,
    "filter_series": lambda s, d: va.filter_series(sales_panel(s, d), "PROMO", 3),
    "check_required_columns": lambda s, d: va.check_required_columns(raw_sales(s, d).drop("onpromotion").withColumnRenamed("sales", "amount")),
    "check_date_parse": lambda s, d: va.check_date_parse(raw_text(s, d)),
    "check_sales_numeric": lambda s, d: va.check_sales_numeric(raw_text(s, d)),
    "count_duplicates": lambda s, d: va.count_duplicates(raw_sales(s, d)),
    "check_negatives": lambda s, d: va.check_negatives(raw_sales(s, d)),
    "check_min_history": lambda s, d: va.check_min_history(raw_sales(s, d)),
    "profile_raw": lambda s, d: va.profile_raw(raw_text(s, d)),
    "panel_completeness": lambda s, d: va.panel_completeness(sales_panel(s, d)),
    "validation_report": lambda s, d: va.validation_report(raw_sales(s, d)),
    "validation_report_errors": lambda s, d: va.validation_report(raw_text(s, d)),
    "options": lambda s, d: va.options(sales_panel(s, d)),
    "forecast_request_check": lambda s, d: va.forecast_request_check(forecast_requests(s, d), sales_panel(s, d)),
    # cleaning
    "coerce_types": lambda s, d: cl.coerce_types(raw_text(s, d)),
    "canonical_sort": lambda s, d: cl.canonical_sort(sales_panel(s, d)),
    "merge_duplicates": lambda s, d: cl.merge_duplicates(raw_sales(s, d)),
    "clip_negative": lambda s, d: cl.clip_negative(raw_sales(s, d)),
    "max_missing_run": lambda s, d: cl.max_missing_run(gapped(s, d)),
    "fill_time_linear": lambda s, d: rounded(cl.fill_time_linear(gapped(s, d))),
    "fill_month_mean": lambda s, d: rounded(cl.fill_month_mean(gapped(s, d))),
    "fill_median": lambda s, d: rounded(cl.fill_median(gapped(s, d))),
    "fill_promo": lambda s, d: cl.fill_promo(promo_gaps(s, d)),
    "handle_missing": lambda s, d: rounded(cl.handle_missing(gapped(s, d))),
    "flag_events": lambda s, d: cl.flag_events(sales_panel(s, d), calendar(s)),
    "rolling_median7": lambda s, d: merged(s, d).withColumn("med", F.round(cl.rolling_median7(), 6)).select(*KEYS, "med"),
    "iqr_fence": lambda s, d: merged(s, d).withColumn("fence", F.round(cl.iqr_fence(), 6)).groupBy(*SERIES).agg(F.max("fence").alias("fence")),
    "spike_candidates": lambda s, d: cl.with_spike_candidates(cl.flag_events(gapped(s, d).fillna({"sales": 0.0}), calendar(s))).filter("candidate").select(*KEYS, "sales", "med"),
    "replace_spikes": lambda s, d: _spikes(s, d).filter("is_outlier").select(*KEYS, "sales"),
    "handle_outliers": lambda s, d: cl.handle_outliers(merged(s, d), calendar(s)),
    "clean": lambda s, d: rounded(cl.clean(raw_sales(s, d), calendar(s))),
    "clean_keep_missing": lambda s, d: rounded(cl.clean(raw_sales(s, d), calendar(s), keep_missing=True)),
    # features
    "load_events": lambda s, d: cl.load_events(order_calendar(s, d)),
    "calendar_parts": lambda s, d: ft.calendar_parts(sales_panel(s, d).select(*KEYS)),
    "is_holiday": lambda s, d: ft.is_holiday(sales_panel(s, d).select(*KEYS), calendar(s)),
    "lags": lambda s, d: ft.lags(sales_panel(s, d)),
    "rolling_means": lambda s, d: rounded(ft.rolling_means(sales_panel(s, d))),
    "feature_engineering": lambda s, d: rounded(ft.feature_engineering(sales_panel(s, d), calendar(s))),
    "minmax_train": lambda s, d: rounded(ft.minmax_train(ft.split_chrono(sales_panel(s, d)))),
    "split_chrono": lambda s, d: ft.split_chrono(sales_panel(s, d)).groupBy(*SERIES, "split").agg(F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")),
    "split_forecast": lambda s, d: ft.split_forecast(sales_panel(s, d)).groupBy(*SERIES, "split").agg(F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")),
    "sliding_windows": _windows_flat,
    "align_regressor": lambda s, d: ft.align_regressor(sales_panel(s, d), _regressor(s, d)),
    "floor_zero": lambda s, d: merged(s, d).select(*KEYS, ft.floor_zero(F.col("sales")).alias("y")),
    "holiday_windows": lambda s, d: ft.holiday_windows(order_calendar(s, d)),
    "difference": lambda s, d: ft.difference(sales_panel(s, d), 2).select(*KEYS, "diff"),
    "future_dates": lambda s, d: ft.future_dates(sales_panel(s, d), 30),
    "future_regressor": lambda s, d: ft.future_regressor(ft.future_dates(sales_panel(s, d), 30), _planned(s, d)),
    "safe_key": lambda s, d: table(s, d, "part").select("p_partkey", safe_key(F.concat_ws(",", "p_type", "p_name", "p_brand")).alias("key")),
    "sanitize_numbers": _ratios,
    "label_join": lambda s, d: sales_panel(s, d).select("family").distinct().select("family", family_label(F.col("family")).alias("label")),
    # totals
    "daily_total": lambda s, d: agg.daily_total(sales_panel(s, d)),
    "by_family": lambda s, d: agg.by_family(sales_panel(s, d)),
    "by_store": lambda s, d: agg.by_store(sales_panel(s, d)),
    "totals_grouping_sets": lambda s, d: agg.totals_grouping_sets(sales_panel(s, d)),
    "by_family_store": _series_points,
    "dataset_summary": _summary_flat,
    # analyses
    "overview": lambda s, d: rounded(an.overview(sales_panel(s, d))),
    "yoy_growth": lambda s, d: an.yoy_growth(sales_panel(s, d)),
    "best_family": lambda s, d: an.best_family(sales_panel(s, d)),
    "trend_daily": lambda s, d: an.trend(sales_panel(s, d), "daily"),
    "trend_daily_or_weekly": lambda s, d: an.trend(sales_panel(s, d), "daily", weekly_above=DAILY_TREND_LIMIT),
    "trend_daily_one_series": lambda s, d: an.trend(sales_panel(s, d), "daily", family="SMALL", store_nbr=4),
    "trend_weekly": lambda s, d: an.trend(sales_panel(s, d), "weekly"),
    "trend_monthly": lambda s, d: an.trend(sales_panel(s, d), "monthly"),
    "monthly_comparison": _monthly_wide,
    "monthly_comparison_long": lambda s, d: an.monthly_comparison_long(sales_panel(s, d)),
    "category_share": lambda s, d: rounded(an.category_share(sales_panel(s, d))),
    "top_families": lambda s, d: rounded(an.top_families(sales_panel(s, d), 10)),
    "correlation": lambda s, d: rounded(an.correlation(sales_panel(s, d))),
    "weekday_pattern": lambda s, d: rounded(an.weekday_pattern(sales_panel(s, d))),
    "seasonal_classical": lambda s, d: rounded(an.seasonal_classical(sales_panel(s, d)), "trend", "seasonal", "residual", offset=1e-8),
    "promo_effect": lambda s, d: rounded(an.promo_effect(sales_panel(s, d))),
    "promo_effect_by_family": lambda s, d: rounded(an.promo_effect_by_family(sales_panel(s, d))),
    "analysis_report": _report,
}
