"""Registered queries: files in and out. Each one lands data derived from the given tables first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import aggregate as agg
from shelfcast.operators import clean as cl
from shelfcast.plans.process import process, process_report
from shelfcast.schema import SERIES
from shelfcast.sources import files
from shelfcast.sources.landed import all_charsets, read_landed
from shelfcast.sources.scratch import scratch_path
from shelfcast.sources.tables import calendar, order_calendar, raw_sales, raw_text, sales_panel
from shelfcast.streaming.ingest import ingest_stream, read_ledger

Query = Callable[[SparkSession, str], DataFrame]


def _read_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    raw_text(spark, sf).write.option("header", True).csv(path)
    df = files.read_sales_csv(spark, path)
    return df.withColumn("sales", F.col("sales").cast("double"))


def uploaded_files(spark: SparkSession, sf: str) -> DataFrame:
    """(path, length, content): one file per store and month, its encoding by month, a Chinese note in each."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = ("utf-8", "utf-8-sig", "gbk")
        for batch in batches:
            content = [text.encode(kinds[k]) for text, k in zip(batch["text"], batch["kind"])]
            yield pd.DataFrame({"path": batch["path"], "length": [len(c) for c in content], "content": content})

    cells = [F.coalesce(c, F.lit("")) for c in ("family", "sales", "date", "store_nbr", "onpromotion")]
    month = F.substring("date", 1, 7)
    lines = raw_text(spark, sf).groupBy("store_nbr", month.alias("month")).agg(F.sort_array(F.collect_list(F.concat_ws(",", *cells, F.lit("备注")))).alias("lines"))
    number = F.coalesce(F.substring("month", 6, 2).try_cast("int"), F.lit(0))
    texts = lines.select(
        F.concat_ws("-", "store_nbr", "month", F.lit("sales.csv")).alias("path"),
        F.concat(F.lit("family,sales,date,store_nbr,onpromotion,备注\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("text"),
        (number % 3).alias("kind"),
    )
    return texts.mapInPandas(encode, "path string, length bigint, content binary")


def _read_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = files.read_sales_files(uploaded_files(spark, sf))
    return rows.groupBy("path", "reason").agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.col("sales").cast("double")), F.lit(0.0)).alias("sales"),
        F.count_if(F.col("date") == "bad-date").alias("bad_dates"),
    )


def _read_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The raw text lands as files of any size, those of even stores in GBK, with other columns in another order."""
    path, raw = scratch_path(spark, "landed"), raw_text(spark, sf)
    even = F.col("store_nbr").cast("int") % 2 == 0
    with all_charsets(spark):
        for encoding, part in (("GBK", raw.filter(even)), ("UTF-8", raw.filter(~even))):
            named = part.select("family", "sales", F.lit("备注").alias("备注"), "date", "store_nbr", *(["onpromotion"] if encoding == "GBK" else []))
            named.write.mode("append").option("header", True).option("encoding", encoding).csv(path)
    return read_landed(spark, path).groupBy("store_nbr", "encoding", "reason").agg(
        F.count("*").alias("rows"),
        F.round(F.sum(F.col("sales").cast("double")), 2).alias("sales"),
        F.count_if(F.col("date") == "bad-date").alias("bad_dates"),
        F.count("onpromotion").alias("promotions"),
    )


def _gate(spark: SparkSession, sf: str) -> DataFrame:
    """The uploaded files under names whose suffix goes by store."""
    suffix = F.element_at(F.array(*[F.lit(s) for s in (".csv", ".CSV", ".xls", ".xlsx", ".json")]), F.substring("path", 1, 1).cast("int"))
    named = uploaded_files(spark, sf).select(F.concat(F.regexp_replace("path", r"\.csv$", ""), suffix).alias("path"), "length")
    return files.file_gate(named).drop("length")


def _subset(spark: SparkSession, sf: str) -> DataFrame:
    return files.extract_subset(sales_panel(spark, sf), scratch_path(spark, "subset"), (1, 3, 5))


def _two_sessions(spark: SparkSession, sf: str, wanted: str) -> DataFrame:
    """Two sessions with different columns in one table; the second write of a session replaces the first."""
    path, panel = scratch_path(spark, "clean"), sales_panel(spark, sf)
    files.write_session(panel, path, "second")
    files.write_session(panel, path, "first")
    files.write_session(cl.clean(raw_sales(spark, sf), calendar(spark)), path, "second")
    return files.load_session(spark, path, wanted)


def _process(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "upload")
    raw_sales(spark, sf).write.option("header", True).csv(f"{path}/raw")
    return process(spark, files.read_sales_csv(spark, f"{path}/raw"), calendar(spark), f"{path}/out", "s1")


def _upload_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What the upload path says of the raw rows it saw and of the panel it saved."""
    summary = process_report(spark, raw_sales(spark, sf), calendar(spark), scratch_path(spark, "upload"), "s1")[1]
    rate = F.round("completeness_rate", 6).alias("completeness_rate")
    return summary.select("session_id", "total_rows", "missing_before", "missing_after", rate, F.array_join("warnings", ", ").alias("warnings"))


def _save_daily(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "daily")
    files.write_session(agg.daily_total(sales_panel(spark, sf)), path, "s1")
    return files.load_session(spark, path, "s1")


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    files.write_summary(cl.clean(raw_sales(spark, sf), calendar(spark)), path, "s1")
    read = spark.read.json(path).select("session_id", "summary.*")
    return read.select(
        "session_id", "total_rows", "start", "end", "days", "family_count", "store_count", "outliers_replaced", "outliers_kept",
        F.aggregate("families", F.lit(0.0), lambda a, f: a + f["total_sales"]).alias("total_sales"),
        F.array_join(F.transform("families", lambda f: f["label"]), ",").alias("labels"),
    )


def _calendar_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "calendar")
    order_calendar(spark, sf).write.option("header", True).csv(path)
    return cl.load_events(files.read_calendar(spark, path))


def _export(spark: SparkSession, sf: str) -> DataFrame:
    """Each series as a stored result: with bounds two values short, and without bounds."""
    points = agg.by_family_store(sales_panel(spark, sf))
    sales = lambda k: F.transform("points", lambda p: p["sales"] * k)
    short = lambda k: F.when(F.col("model") == "ARIMA", F.slice(sales(k), F.lit(1), F.greatest(F.size("points") - 2, F.lit(0))))
    results = points.withColumn("model", F.explode(F.array(F.lit("ARIMA"), F.lit("LSTM")))).select(
        *SERIES, "model", F.transform("points", lambda p: p["date"]).alias("dates"), sales(1.0).alias("forecast"), short(0.5).alias("lower_ci"), short(1.5).alias("upper_ci")
    )
    rows = files.export_forecast(results)
    path = scratch_path(spark, "export")
    files.write_forecast(rows, path)
    return spark.read.option("header", True).schema(rows.schema).csv(path)


def _ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sales land as files that each hold whole series, in two rounds; the stream runs after each."""
    base = scratch_path(spark, "stream")
    raw = raw_sales(spark, sf).select("date", "store_nbr", "family", "sales", "onpromotion")
    for stores in (F.col("store_nbr") <= 2, F.col("store_nbr") > 2):
        raw.filter(stores).repartition(*SERIES).write.mode("append").option("header", True).csv(f"{base}/landing")
        ingest_stream(spark, f"{base}/landing", f"{base}/out", f"{base}/state", calendar(spark), files_per_batch=4)
    return spark.read.parquet(f"{base}/out/clean").drop("session_id")


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sales land as files that two streams bring, the second one twice: rows by landing, and those of the clean table as landing 0."""
    base = scratch_path(spark, "stream")
    raw_sales(spark, sf).select("date", "store_nbr", "family", "sales", "onpromotion").repartition(*SERIES).write.option("header", True).csv(f"{base}/landing")
    for state in ("first", "second", "second"):
        ingest_stream(spark, f"{base}/landing", f"{base}/out", f"{base}/{state}", calendar(spark))
    landings = read_ledger(spark, f"{base}/out").groupBy("landing", "reason").agg(F.sum("rows").alias("rows"))
    clean = spark.read.parquet(f"{base}/out/clean").agg(F.lit(0).cast("long").alias("landing"), F.lit("clean").alias("reason"), F.count("*").alias("rows"))
    return landings.unionByName(clean)


QUERIES: dict[str, Query] = {
    "read_sales_csv": _read_csv,
    "detect_encoding": lambda s, d: files.detect_encoding(uploaded_files(s, d)),
    "read_sales_files": _read_files,
    "read_landed": _read_landed,
    "file_gate": _gate,
    "extract_subset": _subset,
    "process": _process,
    "upload_summary": _upload_summary,
    "write_clean": lambda s, d: _two_sessions(s, d, "second"),
    "load_clean": lambda s, d: _two_sessions(s, d, "first"),
    "write_daily_total": _save_daily,
    "write_summary": _summary,
    "read_calendar": _calendar_file,
    "export_forecast": _export,
    "ingest_stream": _ingest,
    "ingest_ledger": _ledger,
}
