"""Sales analyses over the clean panel, each read from one pass over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.values import family_label, month_label, ratio, week_end, week_label
from shelfcast.operators.validate import filter_series
from shelfcast.sources.scratch import snapshot


def overview(df: DataFrame) -> DataFrame:
    """One row of headline figures.

    Grouping sets by day, family, store and year shrink the panel in one pass; the second aggregate
    reads every figure from those few rows.
    """
    sets = (
        df.select("date", "family", "store_nbr", F.year("date").alias("year"), "sales")
        .groupingSets([["date"], ["family"], ["store_nbr"], ["year"]], "date", "family", "store_nbr", "year")
        .agg(F.grouping_id().alias("gid"), F.sum("sales").alias("s"))
    )
    day, fam, store, year = (F.col("gid") == g for g in (7, 11, 13, 14))
    facts = sets.agg(
        F.sum(F.when(day, F.col("s"))).alias("total_sales"),
        F.count_if(day).alias("days"),
        F.min("date").alias("start"),
        F.max("date").alias("end"),
        F.count_if(fam).alias("family_count"),
        F.count_if(store).alias("store_count"),
        F.min(F.when(fam, F.struct((-F.col("s")).alias("minus"), F.col("family").alias("name")))).alias("best"),
        F.sort_array(F.collect_list(F.when(year, F.struct("year", "s"))), asc=False).alias("years"),
    )
    last, prev = F.try_element_at("years", F.lit(1))["s"], F.try_element_at("years", F.lit(2))["s"]
    return facts.select(
        "total_sales",
        F.coalesce(ratio(F.col("total_sales"), F.col("days")), F.lit(0.0)).alias("avg_daily_sales"),
        F.when(prev > 0, F.round((last - prev) / F.nullif(prev, F.lit(0.0)) * 100, 2)).alias("yoy_growth"),
        F.col("best.name").alias("best_family"),
        family_label(F.col("best.name")).alias("best_family_label"),
        (-F.col("best.minus")).alias("best_family_sales"),
        "start",
        "end",
        "days",
        "store_count",
        "family_count",
    )


def yoy_growth(df: DataFrame) -> DataFrame:
    """Last present year against the present year before it, as a percentage; NULL when that cannot be."""
    years = df.groupBy(F.year("date").alias("year")).agg(F.sum("sales").alias("s"))
    ranked = years.agg(F.sort_array(F.collect_list(F.struct("year", "s")), asc=False).alias("years"))
    last, prev = F.try_element_at("years", F.lit(1)), F.try_element_at("years", F.lit(2))
    return ranked.select(
        last["year"].alias("year"),
        prev["year"].alias("previous_year"),
        F.when(prev["s"] > 0, F.round((last["s"] - prev["s"]) / F.nullif(prev["s"], F.lit(0.0)) * 100, 2)).alias("yoy_growth"),
    )


def best_family(df: DataFrame) -> DataFrame:
    totals = df.groupBy("family").agg(F.sum("sales").alias("sales"))
    best = totals.orderBy(F.desc("sales"), "family").limit(1)
    return best.select("family", family_label(F.col("family")).alias("label"), "sales")


def _with_empty(buckets: DataFrame, step: Column) -> DataFrame:
    """Adds the buckets missing up to the next present one, with sales 0.

    The ordered window holds at most one row per calendar day, so a single task is enough.
    """
    until = F.coalesce(F.date_sub(F.lead("bucket").over(Window.orderBy("bucket")), 1), F.col("bucket"))
    rows = buckets.withColumn("until", until).withColumn("at", F.explode(F.sequence(F.col("bucket"), F.col("until"), step)))
    return rows.withColumn("sales", F.when(F.col("at") == F.col("bucket"), F.col("sales")).otherwise(0.0)).drop("bucket", "until")


def trend(df: DataFrame, granularity: str = "monthly", family: str = "all", store_nbr: int = 0, weekly_above: int | None = None) -> DataFrame:
    """(label, sales) per day, week ending on Sunday, or month; buckets without sales in between are 0.

    With `weekly_above`, a daily request for more days than that is answered by weeks, as the labels show. An empty selection gives an empty result; an
    unknown granularity is refused.
    """
    daily = filter_series(df, family, store_nbr).groupBy("date").agg(F.sum("sales").alias("sales"))
    if granularity == "monthly":
        months = daily.groupBy(F.trunc("date", "month").alias("bucket")).agg(F.sum("sales").alias("sales"))
        return _with_empty(months, F.expr("interval 1 month")).select(month_label(F.col("at")).alias("label"), "sales").orderBy("label")
    if granularity == "weekly":
        weekly = F.lit(True)
    elif granularity == "daily":
        weekly = F.lit(False) if weekly_above is None else F.count("*").over(Window.partitionBy()) > weekly_above
    else:
        raise ValueError(f"granularity must be daily, weekly or monthly, not {granularity!r}")
    bucket = F.when(F.col("weekly"), week_end(F.col("date"))).otherwise(F.col("date"))
    buckets = daily.withColumn("weekly", weekly).groupBy("weekly", bucket.alias("bucket")).agg(F.sum("sales").alias("sales"))
    filled = _with_empty(buckets, F.make_dt_interval(days=F.when(F.col("weekly"), 7).otherwise(1)))
    label = F.when(F.col("weekly"), week_label(F.col("at"))).otherwise(F.date_format("at", "yyyy-MM-dd"))
    return filled.orderBy("at").select(label.alias("label"), "sales")


def monthly_comparison_long(df: DataFrame) -> DataFrame:
    """(year, month, sales) for the twelve months of each present year; a missing month is NULL.

    Empty when the data spans fewer than 13 months.
    """
    months = df.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("sales").alias("sales"))
    years = months.groupBy("year").agg(
        F.map_from_entries(F.collect_list(F.struct("month", "sales"))).alias("by_month"),
        F.min(F.col("year") * 12 + F.col("month")).alias("first"),
        F.max(F.col("year") * 12 + F.col("month")).alias("last"),
    )
    everything = Window.partitionBy()  # one row per year
    spanned = years.withColumn("span", F.max("last").over(everything) - F.min("first").over(everything)).filter("span >= 13")
    return spanned.select("year", "by_month", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).select(
        "year", "month", F.try_element_at("by_month", F.col("month")).alias("sales")
    )


def monthly_comparison(df: DataFrame) -> DataFrame:
    """Month rows, one column per present year. The written long form also yields the column names."""
    long = snapshot(monthly_comparison_long(df), "monthly")
    years = [r["year"] for r in long.select("year").distinct().orderBy("year").collect()]
    if not years:
        return long.select("month").limit(0)
    return long.groupBy("month").pivot("year", years).agg(F.first("sales")).orderBy("month")


def category_share(df: DataFrame) -> DataFrame:
    """Sum, grand total and share per family, by name. Both aggregates read the same shuffle."""
    families = df.groupBy("family").agg(F.sum("sales").alias("sales"))
    total = families.agg(F.sum("sales")).scalar()
    return families.select(
        "family", family_label(F.col("family")).alias("label"), "sales", total.alias("total"), (ratio(F.col("sales"), total) * 100).alias("share")
    )


def top_families(df: DataFrame, n: int = 10) -> DataFrame:
    """The n families with the largest sums, at least one."""
    n = max(1, int(n))
    promo = F.avg("onpromotion") if "onpromotion" in df.columns else F.lit(None).cast("double")
    totals = df.groupBy("family").agg(F.sum("sales").alias("sales"), promo.alias("onpromotion_avg"))
    return totals.orderBy(F.desc("sales"), "family").limit(n).select("family", family_label(F.col("family")).alias("label"), "sales", "onpromotion_avg")


def correlation(df: DataFrame) -> DataFrame:
    """Pearson matrix (family_1, family_2, corr) of family daily totals, a missing day counting as 0.

    Every day becomes one vector of centred totals, so nothing cancels in the sums of products. Each pair is summed once,
    map-side first. A constant family gives NULL; a single family gives no rows.
    """
    daily = df.dropna(subset=["date", "family"]).groupBy("date", "family").agg(F.sum("sales").alias("s"))
    days = daily.agg(F.count_distinct("date")).scalar()
    facts = daily.groupBy("family").agg(
        F.count("s").alias("n"), F.sum("s").alias("total"), F.min("s").alias("lo"), F.max("s").alias("hi")
    ).withColumn("days", days)
    varies = (F.col("lo") < F.col("hi")) | ((F.col("n") < F.col("days")) & (F.col("lo") != 0))
    family = F.struct("family", F.when(varies, F.col("total") / F.col("days")).alias("mean"))
    families = facts.agg(F.sort_array(F.collect_list(family))).scalar()
    totals = daily.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("family", "s"))).alias("known"))
    vectors = totals.withColumn("families", families).filter(F.size("families") >= 2)
    vectors = vectors.select(
        F.transform(
            "families",
            lambda f: F.struct(f["family"].alias("f"), (F.coalesce(F.try_element_at("known", f["family"]), F.lit(0.0)) - f["mean"]).alias("x")),
        ).alias("v")
    )
    firsts = vectors.select("v", F.posexplode("v").alias("at", "a"))
    pairs = firsts.select("a", F.explode(F.slice("v", F.col("at") + 1, F.size("v") - F.col("at"))).alias("b"))
    sums = pairs.groupBy(F.col("a.f").alias("f1"), F.col("b.f").alias("f2")).agg(F.sum(F.col("a.x") * F.col("b.x")).alias("dot"))
    there = F.struct(F.col("f1").alias("family_1"), F.col("f2").alias("family_2"))
    back = F.struct(F.col("f2").alias("family_1"), F.col("f1").alias("family_2"))
    matrix = sums.select("dot", F.inline(F.when(F.col("f1") == F.col("f2"), F.array(there)).otherwise(F.array(there, back))))
    own = F.when(F.col("family_1") == F.col("family_2"), F.sqrt("dot"))
    one, two = (F.max(own).over(Window.partitionBy(c)) for c in ("family_1", "family_2"))
    return matrix.withColumns({"one": one, "two": two}).select("family_1", "family_2", ratio(F.col("dot"), F.col("one") * F.col("two")).alias("corr"))


def weekday_pattern(df: DataFrame) -> DataFrame:
    """Mean row sales per weekday, Monday 0; a missing weekday is 0."""
    means = df.groupBy(F.weekday("date").alias("weekday")).agg(F.avg("sales").alias("avg_sales"))
    week = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    return week.join(means, "weekday", "left").select("weekday", F.coalesce("avg_sales", F.lit(0.0)).alias("avg_sales"))


def _promotion(df: DataFrame) -> DataFrame:
    """The data itself, or with an unknown promotion where it has no such column."""
    return df if "onpromotion" in df.columns else df.withColumn("onpromotion", F.lit(None).cast("long"))


def _promo_means() -> list[Column]:
    return [
        F.avg(F.when(F.col("onpromotion") > 0, F.col("sales"))).alias("promo_avg"),
        F.avg(F.when(F.col("onpromotion") == 0, F.col("sales"))).alias("non_promo_avg"),
    ]


def _lift() -> Column:
    base = F.col("non_promo_avg")
    return F.when(base > 0, F.col("promo_avg") / F.nullif(base, F.lit(0.0)))


def promo_effect(df: DataFrame, family: str = "all") -> DataFrame:
    """Mean sales with and without promotion (0 where there are no rows) and their ratio; no row if the data has no promotions."""
    known = _promotion(df)
    means = filter_series(known, family).agg(*_promo_means())
    means = means if known is df else means.limit(0)
    zero = F.lit(0.0)
    means = means.select(F.coalesce("promo_avg", zero).alias("promo_avg"), F.coalesce("non_promo_avg", zero).alias("non_promo_avg"))
    return means.withColumn("lift", _lift())


def promo_effect_by_family(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Families by lift, a missing lift sorting as 0; no rows on a side give NULL, not 0. Without `top` all families.

    No row if the data has no promotions.
    """
    known = _promotion(df)
    means = known.groupBy("family").agg(*_promo_means()).withColumn("lift", _lift())
    best = (means if known is df else means.limit(0)).orderBy(F.desc(F.coalesce("lift", F.lit(0.0))), "family")
    best = best if top is None else best.limit(top)
    return best.select("family", family_label(F.col("family")).alias("label"), "promo_avg", "non_promo_avg", "lift")


def seasonal_classical(df: DataFrame, period: int = 7, series: tuple[str, ...] = ("family", "store_nbr")) -> DataFrame:
    """Centred moving mean, mean deviation per phase, rest: windows only, all series at once."""
    half = period // 2
    w = Window.partitionBy(*series).orderBy("date")
    phase = Window.partitionBy(*series, "phase")
    return (
        df.withColumn("rn", F.row_number().over(w))
        .withColumn("n", F.count("*").over(Window.partitionBy(*series)))
        .filter(F.col("n") >= 2 * period)
        .withColumn("trend", F.avg("sales").over(w.rowsBetween(-half, period - 1 - half)))
        .withColumn("phase", (F.col("rn") - 1) % period)
        .withColumn("seasonal", F.avg(F.col("sales") - F.col("trend")).over(phase))
        .withColumn("residual", F.col("sales") - F.col("trend") - F.col("seasonal"))
        .select(*series, "date", F.col("sales").alias("observed"), "trend", "seasonal", "residual")
    )


def analysis_report(df: DataFrame) -> DataFrame:
    """All analyses as rows (section, key, label, value).

    The sections branch from one (date, family, store) panel: pass a written one (`snapshot`, or the
    saved clean panel) so that each branch reads that small table and not its sources.
    """

    def section(name: str, frame: DataFrame, key: Column, label: Column, value: Column) -> DataFrame:
        return frame.select(F.lit(name).alias("section"), key.cast("string").alias("key"), label.cast("string").alias("label"), value.cast("double").alias("value"))

    def long(name: str, frame: DataFrame, label: Column, names: list[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in names])
        return section(name, frame.select(label.alias("l"), F.inline(cells)), F.col("k"), F.col("l"), F.col("v"))

    none = F.lit(None).cast("string")
    parts = [
        long("overview", overview(df), F.col("best_family"), ["total_sales", "avg_daily_sales", "yoy_growth", "best_family_sales", "days", "store_count", "family_count"]),
        section("trend", trend(df), F.lit("sales"), F.col("label"), F.col("sales")),
        section("monthly", monthly_comparison_long(df), F.col("year"), F.lpad(F.col("month").cast("string"), 2, "0"), F.col("sales")),
        long("share", category_share(df), F.col("family"), ["sales", "share"]),
        long("top", top_families(df), F.col("family"), ["sales", "onpromotion_avg"]),
        section("correlation", correlation(df), F.col("family_1"), F.col("family_2"), F.col("corr")),
        section("weekday", weekday_pattern(df), F.lit("avg_sales"), F.col("weekday"), F.col("avg_sales")),
        long("promo", promo_effect(df), none, ["promo_avg", "non_promo_avg", "lift"]),
        long("promo_by_family", promo_effect_by_family(df), F.col("family"), ["promo_avg", "non_promo_avg", "lift"]),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
