"""Features and series preparation: expressions and windows over the clean panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.series import ordered, whole
from shelfcast.functions.values import ratio
from shelfcast.operators.clean import flag_events
from shelfcast.schema import EVENT_WINDOWS, LAGS, ROLLING, SERIES, TRAIN_RATIO, VAL_RATIO, WINDOW_LENGTH


def calendar_parts(df: DataFrame) -> DataFrame:
    date = F.col("date")
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "weekday": F.weekday(date),
            "is_weekend": (F.weekday(date) >= 5).cast("int"),
            "week_of_year": F.weekofyear(date),
            "quarter": F.quarter(date),
            "days_to_monthend": F.datediff(F.last_day(date), date),
        }
    )


def is_holiday(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return flag_events(df, calendar, "is_holiday").withColumn("is_holiday", F.col("is_holiday").cast("int"))


def lags(df: DataFrame, by: Sequence[int] = LAGS, series: Sequence[str] = SERIES) -> DataFrame:
    w = ordered(series)
    return df.withColumns({f"sales_lag{k}": F.lag("sales", k).over(w) for k in by})


def rolling_means(df: DataFrame, sizes: Sequence[int] = ROLLING, series: Sequence[str] = SERIES) -> DataFrame:
    """Trailing row means, from the first row on."""
    w = ordered(series)
    return df.withColumns({f"sales_rolling{k}_mean": F.avg("sales").over(w.rowsBetween(1 - k, 0)) for k in sizes})


def feature_engineering(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return rolling_means(lags(is_holiday(calendar_parts(df), calendar)))


# Splits use binary floats on purpose: floor(90 * 0.7) is 62 in doubles and 63 in decimals.


def _numbered(df: DataFrame, series: Sequence[str]) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(ordered(series)).cast("int")).withColumn(
        "n", F.count("*").over(whole(series)).cast("int")
    )


def _with_split(df: DataFrame, train_end: Column, val_end: Column, series: Sequence[str]) -> DataFrame:
    return _numbered(df, series).withColumn(
        "split", F.when(F.col("rn") <= train_end, "train").when(F.col("rn") <= val_end, "val").otherwise("test")
    )


def _share(r: float) -> Column:
    return F.floor(F.col("n") * F.lit(float(r))).cast("int")


def split_chrono(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Train, validation and test rows in time order; both sizes are rounded down."""
    return _with_split(df, _share(TRAIN_RATIO), _share(TRAIN_RATIO) + _share(VAL_RATIO), series)


def split_forecast(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """As `split_chrono`, but the end of validation is rounded down once, as forecasts split."""
    return _with_split(df, _share(TRAIN_RATIO), _share(TRAIN_RATIO + VAL_RATIO), series)


def minmax_train(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Scale by the training minimum and maximum; a constant training part scales by 1."""
    train = F.when(F.col("split") == "train", F.col("sales"))
    low, high = F.min(train).over(whole(series)), F.max(train).over(whole(series))
    return (
        df.withColumn("train_min", low)
        .withColumn("train_range", F.when(high == low, F.lit(1.0)).otherwise(high - low))
        .withColumn("scaled", ratio(F.col("sales") - F.col("train_min"), F.col("train_range")))
    )


def minmax_inverse(scaled: Column) -> Column:
    return scaled * F.col("train_range") + F.col("train_min")


def sliding_windows(df: DataFrame, length: int = WINDOW_LENGTH, value: str = "sales", series: Sequence[str] = SERIES) -> DataFrame:
    """The `length` previous values as an array beside the value to predict; rows without them drop out."""
    past = F.collect_list(value).over(ordered(series).rowsBetween(-length, -1))
    return df.withColumn("window", past).withColumn("label", F.col(value)).filter(F.size("window") == length)


def align_regressor(df: DataFrame, regressor: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Left-align (series, date, onpromotion) to the panel's days; missing is 0."""
    right = regressor.select(*series, "date", F.col("onpromotion").alias("aligned"))
    keep = [c for c in df.columns if c != "onpromotion"]
    return df.select(*keep).join(right, [*series, "date"], "left").select(
        *keep, F.coalesce("aligned", F.lit(0).cast("bigint")).alias("onpromotion")
    )


def floor_zero(c: Column) -> Column:
    """Zero becomes 0.01 where a multiplicative model needs positive values."""
    return F.when(c == 0, F.lit(0.01)).otherwise(c)


def holiday_windows(calendar: DataFrame) -> DataFrame:
    """One row per (event name, covered day)."""
    eligible = calendar.filter(F.col("type").isin(*EVENT_WINDOWS) & ~F.col("transferred"))
    low = F.create_map(*[F.lit(x) for k, v in EVENT_WINDOWS.items() for x in (k, v[0])])
    high = F.create_map(*[F.lit(x) for k, v in EVENT_WINDOWS.items() for x in (k, v[1])])
    days = F.sequence(F.date_add("date", F.try_element_at(low, F.col("type"))), F.date_add("date", F.try_element_at(high, F.col("type"))))
    return eligible.dropna(subset=["date", "description"]).select(F.col("description").alias("holiday"), F.explode(days).alias("date")).distinct()


def difference(df: DataFrame, order: int = 1, series: Sequence[str] = SERIES) -> DataFrame:
    """The order-th difference of each series; its first `order` rows are NULL."""
    df = df.withColumn("diff", F.col("sales"))
    for _ in range(order):
        df = df.withColumn("diff", F.col("diff") - F.lag("diff", 1).over(ordered(series)))
    return df


def future_dates(df: DataFrame, horizon: int, series: Sequence[str] = SERIES) -> DataFrame:
    """The `horizon` days after each series' last day."""
    last = df.groupBy(*series).agg(F.max("date").alias("last_date"))
    days = F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon))
    return last.select(*series, F.posexplode(days).alias("step", "date")).withColumn("step", F.col("step") + 1)


def future_regressor(spine: DataFrame, planned: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Planned promotions (series, step, onpromotion) on the future days: cut or padded with 0 to the horizon."""
    plan = planned.select(*series, "step", F.col("onpromotion").alias("planned"))
    return spine.join(plan, [*series, "step"], "left").select(
        *spine.columns, F.coalesce("planned", F.lit(0).cast("bigint")).alias("onpromotion")
    )
