"""Checks and profiles of raw sales. Each one is a single pass that combines map-side by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.functions.values import family_label, missing_text_to_null, to_day, to_number, to_store
from shelfcast.schema import HORIZON_RANGE, MIN_HISTORY_DAYS, MIN_SERIES_ROWS, MODELS, REQUIRED


def filter_series(df: DataFrame, family: str | None = "all", store_nbr: int | None = 0) -> DataFrame:
    """One family and/or store; 'all', None and 0 keep everything."""
    if family and family != "all":
        df = df.filter(F.col("family") == family)
    if store_nbr:
        df = df.filter(F.col("store_nbr") == int(store_nbr))
    return df


def check_required_columns(df: DataFrame) -> DataFrame:
    """Per required column: whether it is there and how many cells it fills."""
    counts = [(F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(c) for c in REQUIRED]
    rows = [F.struct(F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"), F.col(c).alias("filled")) for c in REQUIRED]
    return df.agg(F.count("*").alias("rows"), *counts).select(F.inline(F.array(*rows)))


def _day(df: DataFrame) -> Column:
    return to_day(F.col("date")) if dict(df.dtypes)["date"] == "string" else F.col("date").try_cast("date")


def _missing(df: DataFrame, c: str) -> Column:
    """NULL, or in a text column one of the texts that stand for it."""
    kind = dict(df.dtypes)[c]
    if kind == "string":
        return missing_text_to_null(F.col(c)).isNull()
    return F.col(c).isNull() | F.isnan(c) if kind in ("double", "float") else F.col(c).isNull()


def _bad_dates(df: DataFrame) -> Column:
    return F.count_if(_day(df).isNull() & ~_missing(df, "date"))


def _bad_stores(df: DataFrame) -> Column:
    return F.count_if(to_store(F.col("store_nbr")).isNull() & ~_missing(df, "store_nbr"))


def check_date_parse(df: DataFrame) -> DataFrame:
    """Unreadable, non-empty dates: any of them is an error."""
    return df.agg(_bad_dates(df).alias("bad_dates")).select("bad_dates", (F.col("bad_dates") == 0).alias("ok"))


def check_sales_numeric(df: DataFrame) -> DataFrame:
    """An error only when no sales value at all is a number."""
    numeric = F.count(to_number(F.col("sales")))
    return df.agg(numeric.alias("numeric_rows")).select("numeric_rows", (F.col("numeric_rows") > 0).alias("ok"))


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows that share (date, family, store), every member counted. NULL keys are equal."""
    sizes = df.groupBy("date", "family", "store_nbr").agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"))


def _negatives(df: DataFrame) -> list[Column]:
    promo = F.count_if(to_number(F.col("onpromotion")) < 0) if "onpromotion" in df.columns else F.lit(0).cast("bigint")
    return [F.count_if(to_number(F.col("sales")) < 0).alias("negative_sales"), promo.alias("negative_promo")]


def check_negatives(df: DataFrame) -> DataFrame:
    return df.agg(*_negatives(df))


def check_min_history(df: DataFrame) -> DataFrame:
    """Distinct days, and whether they are enough for a forecast."""
    days = df.agg(F.count_distinct(_day(df)).alias("days"))
    return days.select("days", (F.col("days") >= MIN_HISTORY_DAYS).alias("enough"))


def _null_cells(df: DataFrame) -> Column:
    return sum((_missing(df, c).cast("int") for c in df.columns), F.lit(0))


def _key_profile(df: DataFrame) -> DataFrame:
    """Raw rows folded to one row per key; everything else is derived from this smaller table."""
    return df.groupBy("date", "family", "store_nbr").agg(
        F.count("*").alias("n"),
        F.sum(_null_cells(df)).alias("null_cells"),
        F.count(to_number(F.col("sales"))).alias("numeric"),
        _bad_dates(df).alias("bad_dates"),
        _bad_stores(df).alias("bad_stores"),
        F.count_if(_missing(df, "date") | _missing(df, "family") | _missing(df, "store_nbr")).alias("null_keys"),
        *_negatives(df),
    )


def profile_raw(df: DataFrame) -> DataFrame:
    """Long form (stat, value): rows, start, end, days, null_cells, duplicate_rows, each family, each store.

    Grouping sets over the key profile: the raw table is read once and no list of names is gathered
    in one cell.
    """
    sets = (
        _key_profile(df)
        .withColumn("day", _day(df))
        .withColumn("duplicates", F.when(F.col("n") > 1, F.col("n")).otherwise(0))
        .groupingSets([["day"], ["family"], ["store_nbr"]], "day", "family", "store_nbr")
        .agg(
            F.grouping_id().alias("gid"),
            F.sum("n").alias("n"),
            F.sum("null_cells").alias("null_cells"),
            F.sum("duplicates").alias("duplicates"),
        )
    )
    is_day, is_family = F.col("gid") == 3, F.col("gid") == 5
    kind = F.when(is_day, "day").when(is_family, "family").otherwise("store")
    value = F.when(is_family, F.col("family")).when(~is_day, F.col("store_nbr").cast("string"))
    folded = (
        sets.select(kind.alias("kind"), value.alias("value"), "day", "n", "null_cells", "duplicates")
        .filter((F.col("kind") == "day") | F.col("value").isNotNull())
        .groupBy("kind", "value")
        .agg(
            F.sum("n").alias("rows"),
            F.min("day").alias("start"),
            F.max("day").alias("end"),
            F.count("day").alias("days"),
            F.sum("null_cells").alias("null_cells"),
            F.sum("duplicates").alias("duplicate_rows"),
        )
    )
    stats = ["rows", "start", "end", "days", "null_cells", "duplicate_rows"]
    totals = F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("string").alias("value")) for s in stats])
    named = F.array(F.struct(F.col("kind").alias("stat"), "value"))
    return folded.select(F.inline(F.when(F.col("kind") == "day", totals).otherwise(named)))


def panel_completeness(df: DataFrame) -> DataFrame:
    """Stores x families x days against the rows that are there."""
    counts = df.agg(
        F.count_distinct("store_nbr").alias("stores"),
        F.count_distinct("family").alias("families"),
        F.count_distinct("date").alias("days"),
        F.count("*").alias("actual_rows"),
    )
    expected = F.col("stores") * F.col("families") * F.col("days")
    return counts.select("*", expected.alias("expected_rows"), (expected == F.col("actual_rows")).alias("complete"))


def validation_report(df: DataFrame) -> DataFrame:
    """Rows (level, code, n): errors first; warnings and stats only when there is no error."""
    missing = missing_columns(df)
    if missing:
        rows = [F.struct(F.lit("error").alias("level"), F.lit(f"missing_column:{c}").alias("code"), F.lit(1).cast("bigint").alias("n")) for c in missing]
        return df.agg(F.count("*").alias("rows")).select(F.inline(F.array(*rows)))
    facts = _key_profile(df).agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum("bad_dates"), F.lit(0)).alias("bad_dates"),
        F.coalesce(F.sum("bad_stores"), F.lit(0)).alias("bad_stores"),
        F.coalesce(F.sum("null_keys"), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum("numeric"), F.lit(0)).alias("numeric"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicates"),
        F.sum("negative_sales").alias("negative_sales"),
        F.sum("negative_promo").alias("negative_promo"),
        F.sum("null_cells").alias("null_cells"),
        F.count_distinct(_day(df)).alias("days"),
    )

    def row(level: str, code: str, n: Column, shown: Column) -> Column:
        return F.when(shown, F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), n.cast("bigint").alias("n")))

    no_error = (F.col("bad_dates") == 0) & (F.col("bad_stores") == 0) & (F.col("numeric") > 0)
    lines = [
        row("error", "bad_date", F.col("bad_dates"), F.col("bad_dates") > 0),
        row("error", "bad_store", F.col("bad_stores"), F.col("bad_stores") > 0),
        row("error", "no_numeric_sales", F.col("rows"), F.col("numeric") == 0),
        row("warning", "duplicate_rows", F.col("duplicates"), no_error & (F.col("duplicates") > 0)),
        row("warning", "null_keys", F.col("null_keys"), no_error & (F.col("null_keys") > 0)),
        row("warning", "negative_sales", F.col("negative_sales"), no_error & (F.col("negative_sales") > 0)),
        row("warning", "negative_promo", F.col("negative_promo"), no_error & (F.col("negative_promo") > 0)),
        row("warning", "short_history", F.col("days"), no_error & (F.col("days") < MIN_HISTORY_DAYS)),
        row("stat", "rows", F.col("rows"), no_error),
        row("stat", "days", F.col("days"), no_error),
        row("stat", "null_cells", F.col("null_cells"), no_error),
        row("stat", "duplicate_rows", F.col("duplicates"), no_error),
    ]
    return facts.select(F.inline(F.array_compact(F.array(*lines))))


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED if c not in df.columns]


def observed_errors(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, with the facts that decide about errors, and those a summary shows, counted while another job reads them."""
    facts = Observation()
    no_key = _day(df).isNull() | to_store(F.col("store_nbr")).isNull() | F.col("family").isNull()
    counts = [_bad_dates(df).alias("bad_date"), _bad_stores(df).alias("bad_store"), F.count(to_number(F.col("sales"))).alias("numeric")]
    return df.observe(facts, *counts, F.count(F.lit(1)).alias("raw_rows"), F.count_if(no_key).alias("null_keys"), *_negatives(df)), facts


def observed_facts(facts: Observation) -> dict[str, int]:
    """What a summary shows of the raw rows: how many, without a number of sales, without a key, negative ones. A part that is read again may raise a count."""
    seen = facts.get
    return {"raw_rows": seen["raw_rows"], "missing_before": seen["raw_rows"] - seen["numeric"], **{c: seen[c] for c in ("null_keys", "negative_sales", "negative_promo")}}


def require_observed(facts: Observation) -> None:
    """Raises on an error that `observed_errors` saw. Rereading a lost part may raise a count, never hide an error."""
    seen = facts.get
    errors = [f"{code} ({seen[code]})" for code in ("bad_date", "bad_store") if seen[code]]
    if not seen["numeric"]:
        errors.append("no_numeric_sales")
    if errors:
        raise ValueError("; ".join(errors))


def require_valid(df: DataFrame) -> None:
    """The gate before cleaning: raises on any error row. Reads back at most a few error rows."""
    errors = validation_report(df).filter("level = 'error'").collect()
    if errors:
        raise ValueError("; ".join(f"{r['code']} ({r['n']})" for r in errors))


def options(df: DataFrame) -> DataFrame:
    """What can be asked for: each family with its label, each store. One pass with grouping sets."""
    sets = df.groupingSets([["family"], ["store_nbr"]], "family", "store_nbr").agg(F.grouping_id().alias("gid"))
    is_family = F.col("gid") == 1
    value = F.when(is_family, F.col("family")).otherwise(F.col("store_nbr").cast("string"))
    return sets.select(
        F.when(is_family, "family").otherwise("store").alias("kind"),
        value.alias("value"),
        family_label(value).alias("label"),
    ).filter("value is not null")


def forecast_request_check(requests: DataFrame, panel: DataFrame) -> DataFrame:
    """Accept or refuse forecast requests (request_id, family, store_nbr, horizon, models).

    Each request probes the panel's keys for its family, its store and its series. All three look-ups
    are one join, and the panel is read once.
    """
    key = lambda kind, *parts: F.concat_ws("\x01", F.lit(kind), *[F.col(p).cast("string") for p in parts])
    known = (
        panel.groupBy("family", "store_nbr")
        .agg(F.count("*").alias("n"))
        .select(
            "n",
            F.explode(F.array(key("family", "family"), key("store", "store_nbr"), key("series", "family", "store_nbr"))).alias("probe"),
        )
        .groupBy("probe")
        .agg(F.sum("n").alias("n"))
    )
    probes = requests.select(
        "*",
        F.inline(
            F.array(
                F.struct(F.lit("family").alias("kind"), key("family", "family").alias("probe")),
                F.struct(F.lit("store").alias("kind"), key("store", "store_nbr").alias("probe")),
                F.struct(F.lit("series").alias("kind"), key("series", "family", "store_nbr").alias("probe")),
            )
        ),
    )
    found = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(f"n_{kind}")
    seen = probes.join(known, "probe", "left").groupBy("request_id", "family", "store_nbr", "horizon", "models").agg(
        found("family"), found("store"), found("series")
    )
    reason = (
        F.when(F.coalesce(F.col("family"), F.lit("")) == "", "family missing")
        .when(F.coalesce(F.col("store_nbr"), F.lit(0)) == 0, "store missing")
        .when(F.coalesce(F.size("models"), F.lit(0)) <= 0, "no model chosen")
        .when(F.size(F.array_except("models", F.array(*[F.lit(m) for m in MODELS]))) > 0, "model not supported")
        .when(~F.col("horizon").between(*HORIZON_RANGE), "horizon out of range")
        .when(F.col("n_family") == 0, "family unknown")
        .when(F.col("n_store") == 0, "store unknown")
        .when(F.col("n_series") < MIN_SERIES_ROWS, "series too short")
        .otherwise("ok")
    )
    return seen.select("request_id", (reason == "ok").alias("ok"), reason.alias("reason"))
