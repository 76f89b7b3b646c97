"""Cleaning: coerce, merge duplicates, fill gaps, repair spikes.

One shuffle merges the raw rows (map-side partial sums absorb a hot key). From then on a series holds
at most one row per day, and all windows share the (family, store_nbr) partitioning of one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.series import BEFORE, HERE, median_of, neighbours, next_known, ordered, previous_known, up_to_here, whole
from shelfcast.functions.values import clip_low, to_day, to_number, to_store
from shelfcast.schema import (
    EVENT_WINDOWS,
    LONG_GAP,
    SERIES,
    SHORT_GAP,
    SPIKE_FENCE,
    SPIKE_MEDIAN_FACTOR,
    SPIKE_NEIGHBOUR,
    SPIKE_WINDOW,
)


def has_promo(df: DataFrame) -> bool:
    return "onpromotion" in df.columns


def coerce_types(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Unreadable dates and sales become NULL, unreadable promotions 0."""
    cols = [
        to_day(F.col("date")).alias("date"),
        to_store(F.col("store_nbr")).alias("store_nbr"),
        F.col("family").cast("string").alias("family"),
        to_number(F.col("sales")).alias("sales"),
    ]
    if has_promo(df):
        cols.append(F.coalesce(to_number(F.col("onpromotion")).try_cast("bigint"), F.lit(0).cast("bigint")).alias("onpromotion"))
    return df.select(*cols, *extra)


def canonical_sort(df: DataFrame) -> DataFrame:
    """Output order store, family, date. Only for display or files: windows carry their own order."""
    return df.orderBy("store_nbr", "family", "date")


def merge_duplicates(df: DataFrame, keep_missing: bool = False, series: Sequence[str] = SERIES) -> DataFrame:
    """Sum per (date, series); rows with a NULL key vanish.

    A key whose sales are all NULL becomes 0.0, or stays NULL with `keep_missing` so that the gap
    operators can fill it.
    """
    keys = ["date", *series]
    total = F.sum("sales")
    aggs = [(total if keep_missing else F.coalesce(total, F.lit(0.0))).alias("sales")]
    if has_promo(df):
        promo = F.sum("onpromotion")
        aggs.append((promo if keep_missing else F.coalesce(promo, F.lit(0))).alias("onpromotion"))
    return df.dropna(subset=keys).groupBy(*keys).agg(*aggs)


def clip_negative(df: DataFrame) -> DataFrame:
    df = df.withColumn("sales", clip_low(F.col("sales")))
    if has_promo(df):
        df = df.withColumn("onpromotion", F.when(F.col("onpromotion") < 0, F.lit(0).cast("bigint")).otherwise(F.col("onpromotion")))
    return df


# Gaps. Input: unique (series, date) rows with NULL sales; a run counts rows, not days.


def _with_run(df: DataFrame, series: Sequence[str]) -> DataFrame:
    """Adds `gap_run`: the longest run of NULL rows of the series. Windows only, no join back."""
    island = F.count("sales").over(up_to_here(series))
    length = F.count_if(F.col("sales").isNull()).over(Window.partitionBy(*series, "island"))
    return (
        df.withColumn("island", island)
        .withColumn("run", length)
        .withColumn("gap_run", F.max("run").over(whole(series)))
        .drop("island", "run")
    )


def max_missing_run(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Longest run of consecutive NULL rows per series."""
    islands = df.withColumn("island", F.count("sales").over(up_to_here(series)))
    runs = islands.groupBy(*series, "island").agg(F.count_if(F.col("sales").isNull()).alias("run"))
    return runs.groupBy(*series).agg(F.max("run").alias("max_run"))


def _linear(series: Sequence[str]) -> Column:
    known = F.when(F.col("sales").isNotNull(), F.struct("date", "sales"))
    before, after = previous_known(known, series), next_known(known, series)
    weight = F.try_divide(F.datediff(F.col("date"), before["date"]), F.datediff(after["date"], before["date"]))
    between = before["sales"] + (after["sales"] - before["sales"]) * weight
    return F.coalesce(F.col("sales"), between, before["sales"])


def fill_time_linear(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Linear in time between known neighbours; trailing NULLs take the last value, leading ones stay."""
    return df.withColumn("filled", _linear(series)).withColumn("sales", F.col("filled")).drop("filled")


def _month_mean(df: DataFrame, series: Sequence[str], name: str) -> DataFrame:
    carried = previous_known(F.col("sales"), series)
    mean = F.avg("carried").over(Window.partitionBy(*series, "month_no"))
    return (
        df.withColumn("carried", carried)
        .withColumn("month_no", F.month("date"))
        .withColumn(name, F.coalesce(F.col("sales"), mean))
        .drop("carried", "month_no")
    )


def fill_month_mean(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """NULLs take the mean of their month number over the forward-filled series, all years together."""
    return _month_mean(df, series, "filled").withColumn("sales", F.col("filled")).drop("filled")


def _median(series: Sequence[str], wanted: Column | None = None) -> Column:
    """NULLs become the series median; `wanted` spares the series that do not need it the counting."""
    known = F.col("sales") if wanted is None else F.when(wanted, F.col("sales"))
    return F.coalesce(F.col("sales"), F.percentile(known, F.lit(0.5)).over(whole(series)))


def fill_median(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    return df.withColumn("sales", _median(series))


def fill_promo(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Forward, then backward, then 0."""
    promo = F.col("onpromotion")
    filled = F.coalesce(previous_known(promo, series), next_known(promo, series), F.lit(0))
    return df.withColumn("filled", filled).withColumn("onpromotion", F.col("filled")).drop("filled")


def handle_missing(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """One filling rule per whole series, chosen by its longest gap; what is left becomes 0."""
    df = _with_run(df, series)
    df = _month_mean(df, series, "by_month").withColumn("by_line", _linear(series))
    df = df.withColumn("by_median", _median(series, F.col("gap_run") > LONG_GAP))
    sales = (
        F.when(F.col("gap_run") <= SHORT_GAP, F.col("by_line"))
        .when(F.col("gap_run") <= LONG_GAP, F.col("by_month"))
        .otherwise(F.col("by_median"))
    )
    df = df.withColumn("sales", clip_low(F.coalesce(sales, F.lit(0.0)))).drop("gap_run", "by_month", "by_line", "by_median")
    return fill_promo(df, series) if has_promo(df) else df


# Spikes. Input: unique (series, date) rows with non-NULL sales.


def load_events(calendar: DataFrame, locale: str | None = None) -> DataFrame:
    """Days that protect a spike: eligible, not transferred; any locale unless one is named."""
    keep = F.col("type").isin(*EVENT_WINDOWS) & ~F.col("transferred") & F.col("date").isNotNull()
    if locale is not None:
        keep = keep & (F.col("locale") == locale)
    return calendar.filter(keep).select("date").distinct()


def flag_events(df: DataFrame, calendar: DataFrame, name: str = "is_event") -> DataFrame:
    """One row per event day is joined, so the calendar's size never multiplies the panel."""
    days = load_events(calendar).withColumn("event_day", F.lit(True))
    return df.join(days, "date", "left").withColumn(name, F.coalesce(F.col("event_day"), F.lit(False))).drop("event_day")


def rolling_median7(series: Sequence[str] = SERIES) -> Column:
    """Median of the up to seven rows centred on the row."""
    before, after = neighbours("sales", SPIKE_WINDOW // 2, series)
    return median_of([*before, F.col("sales"), *after])


def iqr_fence(series: Sequence[str] = SERIES) -> Column:
    """Q3 + 3 (Q3 - Q1) of the whole series, linear quantiles."""
    q = F.percentile("sales", F.array(F.lit(0.25), F.lit(0.75))).over(whole(series))
    return q[1] + SPIKE_FENCE * (q[1] - q[0])


def with_spike_candidates(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Adds rolling median, fence and the flag of rows that exceed both and are no event day."""
    df = df.withColumn("med", rolling_median7(series)).withColumn("fence", iqr_fence(series))
    high = (F.col("med") > 0) & (F.col("sales") > F.col("med") * SPIKE_MEDIAN_FACTOR) & (F.col("sales") > F.col("fence"))
    return df.withColumn("candidate", ~F.col("is_event") & high)


def replace_spikes(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Replace isolated spikes by the rolling median; `is_outlier` marks the replaced rows.

    A spike must stand over twice each of its neighbours, and earlier neighbours count with the value
    they already got. Neighbours that are no candidates never change, so windows test them. Only runs
    of candidates at most three rows apart depend on order; each one is folded left to right.
    """
    half = SPIKE_WINDOW // 2
    w = ordered(series)
    low = lambda values: F.coalesce(F.greatest(*values) < F.col("sales") * SPIKE_NEIGHBOUR, F.lit(True))
    df = (
        with_spike_candidates(df, series)
        .withColumn("rn", F.row_number().over(w))
        .withColumn("fixed", F.when(~F.col("candidate"), F.col("sales")))
        .withColumn("calm", low(neighbours("fixed", half, series)[0]) & low(neighbours("sales", half, series)[1]))
        .withColumn("earlier", F.last(F.when(F.col("candidate"), F.col("rn")), ignorenulls=True).over(w.rowsBetween(BEFORE, -1)))
    )
    opens = F.col("candidate") & F.coalesce(F.col("rn") - F.col("earlier") > half, F.lit(True))
    chain_id = F.when(F.col("candidate"), F.count_if(opens).over(up_to_here(series))).otherwise(0)
    member = F.when(F.col("candidate"), F.struct("rn", F.col("sales").alias("value"), "med", "calm"))
    # The fold's state is the array of members, so each row carries only its own chain.
    chain = F.collect_list(member).over(Window.partitionBy(*series, "chain_id").orderBy("date").rowsBetween(BEFORE, HERE))

    def step(state: Column, c: Column) -> Column:
        near = F.filter(state["near"], lambda s: c["rn"] - s["rn"] <= half)
        hit = c["calm"] & F.forall(near, lambda s: s["value"] < c["value"] * SPIKE_NEIGHBOUR)
        now = F.struct(c["rn"].alias("rn"), F.when(hit, c["med"]).otherwise(c["value"]).alias("value"))
        return F.struct(F.concat(near, F.array(now)).alias("near"), hit.alias("hit"))

    start = F.struct(
        F.array().cast("array<struct<rn:int,value:double>>").alias("near"),
        F.lit(False).alias("hit"),
    )
    hit = F.col("candidate") & F.aggregate("chain", start, step, lambda s: s["hit"])
    return (
        df.withColumn("chain_id", chain_id)
        .withColumn("chain", chain)
        .withColumn("is_outlier", F.coalesce(hit, F.lit(False)))
        .withColumn("sales", F.when(F.col("is_outlier"), F.col("med")).otherwise(F.col("sales")))
        .drop("med", "fence", "candidate", "rn", "fixed", "calm", "earlier", "chain_id", "chain")
    )


def handle_outliers(df: DataFrame, calendar: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    return replace_spikes(flag_events(df, calendar), series)


def merged_panel(raw: DataFrame, keep_missing: bool = False, series: Sequence[str] = SERIES) -> DataFrame:
    """Raw rows to one non-negative row per (date, series): the only step that sees every raw row."""
    extra = [k for k in series if k not in SERIES]
    return clip_negative(merge_duplicates(coerce_types(raw, extra), keep_missing, series))


def clean(raw: DataFrame, calendar: DataFrame, keep_missing: bool = False, series: Sequence[str] = SERIES) -> DataFrame:
    """Raw rows to the clean panel, lazily.

    As defined, duplicates are summed before gaps are filled and an all-NULL sum is 0, so no gap is
    left and the filling step changes nothing: it is planned only with `keep_missing`.
    """
    df = merged_panel(raw, keep_missing, series)
    if keep_missing:
        df = handle_missing(df, series)
    return handle_outliers(df, calendar, series)
