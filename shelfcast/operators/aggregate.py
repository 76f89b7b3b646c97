"""Totals and the dataset summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.values import family_label
from shelfcast.schema import MIN_HISTORY_DAYS, SERIES


def daily_total(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("sales").alias("sales"))


def by_family(df: DataFrame) -> DataFrame:
    return df.groupBy("family").agg(F.sum("sales").alias("total_sales"))


def by_store(df: DataFrame) -> DataFrame:
    return df.groupBy("store_nbr").agg(F.sum("sales").alias("total_sales"))


def totals_grouping_sets(df: DataFrame) -> DataFrame:
    """The three totals in one pass: (kind, key, total_sales)."""
    sets = df.groupingSets([["date"], ["family"], ["store_nbr"]], "date", "family", "store_nbr").agg(
        F.grouping_id().alias("gid"), F.sum("sales").alias("total_sales")
    )
    kind = F.when(F.col("gid") == 3, "date").when(F.col("gid") == 5, "family").otherwise("store")
    key = F.when(F.col("gid") == 3, F.col("date").cast("string")).when(F.col("gid") == 5, F.col("family")).otherwise(F.col("store_nbr").cast("string"))
    return sets.select(kind.alias("kind"), key.alias("key"), "total_sales")


def by_family_store(df: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """One ordered array of (date, sales) per series; at most one entry per calendar day."""
    return df.groupBy(*series).agg(F.sort_array(F.collect_list(F.struct("date", "sales"))).alias("points"))


def _flag(df: DataFrame, name: str):
    return F.count_if(F.col(name)) if name in df.columns else F.lit(0).cast("bigint")


def dataset_summary(df: DataFrame, observed: dict[str, int] | None = None) -> DataFrame:
    """One row: size, range, days, families with totals, stores, NULL sales, spikes replaced, events kept, completeness and warnings.

    observed: counts of the raw rows, from `observed_facts`; without them missing_before is NULL and the warnings are those the panel shows.
    completeness_rate is the share of stores x families x days that have a row, NULL for an empty panel. A warning is a code with its count.

    Grouping sets by day, family and store are folded once more, so the panel is read once. The two
    lists are as long as the family and store dimensions, which is what a summary shows.
    """
    sets = df.groupingSets([["date"], ["family"], ["store_nbr"]], "date", "family", "store_nbr").agg(
        F.grouping_id().alias("gid"),
        F.count("*").alias("n"),
        F.sum("sales").alias("sales"),
        F.count_if(F.col("sales").isNull()).alias("nulls"),
        _flag(df, "is_outlier").alias("replaced"),
        _flag(df, "is_event").alias("kept"),
    )
    day, fam, store = F.col("gid") == 3, F.col("gid") == 5, F.col("gid") == 6
    families = F.collect_list(F.when(fam, F.struct(F.col("family").alias("name"), family_label(F.col("family")).alias("label"), F.col("sales").alias("total_sales"))))
    summary = sets.agg(
        F.sum(F.when(day, F.col("n"))).alias("total_rows"),
        F.min("date").alias("start"),
        F.max("date").alias("end"),
        F.count_if(day & F.col("date").isNotNull()).alias("days"),
        F.sort_array(families).alias("families"),
        F.count_if(fam & F.col("family").isNotNull()).alias("family_count"),
        F.sort_array(F.collect_list(F.when(store, F.col("store_nbr")))).alias("stores"),
        F.count_if(store & F.col("store_nbr").isNotNull()).alias("store_count"),
        F.sum(F.when(day, F.col("nulls"))).alias("missing_after"),
        F.sum(F.when(day, F.col("replaced"))).alias("outliers_replaced"),
        F.sum(F.when(day, F.col("kept"))).alias("outliers_kept"),
    )
    raw = observed or {}
    expected = F.col("store_count") * F.col("family_count") * F.col("days")
    known = {c: F.lit(raw.get(c)).cast("bigint") for c in ("raw_rows", "missing_before", "null_keys", "negative_sales", "negative_promo")}
    counts = {
        "merged_rows": known["raw_rows"] - known["null_keys"] - F.col("total_rows"),
        "null_keys": known["null_keys"],
        "negative_sales": known["negative_sales"],
        "negative_promo": known["negative_promo"],
        "missing_sales": known["missing_before"],
        "incomplete_panel": expected - F.col("total_rows"),
    }
    warnings = [F.when(n > 0, F.concat(F.lit(f"{code} ("), n.cast("string"), F.lit(")"))) for code, n in counts.items()]
    short = F.when(F.col("days") < MIN_HISTORY_DAYS, F.concat(F.lit("short_history ("), F.col("days").cast("string"), F.lit(")")))
    return summary.select(
        "*",
        known["missing_before"].alias("missing_before"),
        F.when(expected > 0, F.col("total_rows") / expected).alias("completeness_rate"),
        F.array_compact(F.array(*warnings, short)).alias("warnings"),
    )
