"""Sales files in, cleaned tables and forecasts out."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.values import missing_text_to_null, to_day
from shelfcast.operators.aggregate import dataset_summary
from shelfcast.schema import ENCODINGS, MAX_FILE_BYTES, NULL_MARKERS, RAW_COLUMNS, TARGET_STORES


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """A header CSV (or a folder of files with one header) as text columns; missing markers are NULL.

    Splittable: one large file is read by many tasks. Files in other encodings or with headers of
    their own go through `landed.read_landed`, or, if they are small, `read_sales_files`.
    """
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    return df.select(*[missing_text_to_null(F.col(f"`{c}`")).alias(c.strip()) for c in df.columns])


def list_files(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """(path, length[, content]) of the files under a folder; the bytes are only read when asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", *(["content"] if content else []))


def file_gate(files: DataFrame) -> DataFrame:
    """(path, length, suffix, accepted, reason): CSV up to 16 MB passes."""
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    reason = (
        F.when(suffix == ".xls", "save .xls as .xlsx or CSV first")
        .when(suffix == ".xlsx", "land .xlsx as CSV or Parquet")
        .when(suffix != ".csv", "file type not supported")
        .when(F.col("length") > MAX_FILE_BYTES, "file larger than 16 MB")
        .otherwise("ok")
    )
    return files.select("path", "length", suffix.alias("suffix"), (reason == "ok").alias("accepted"), reason.alias("reason"))


def _decode(content: bytes) -> tuple[str | None, str]:
    for encoding in ENCODINGS:
        try:
            return encoding, content.decode(encoding).removeprefix("﻿")
        except UnicodeDecodeError:
            continue
    return None, ""


def _content() -> Column:
    """A file's bytes if it can be decoded in one piece; NULL for a larger one, whose row then says so."""
    return F.when(F.col("length") <= MAX_FILE_BYTES, F.col("content")).alias("content")


TOO_LARGE = "larger than 16 MB: read it with read_landed, which splits it"


def detect_encoding(files: DataFrame) -> DataFrame:
    """(path, encoding, reason) from the whole content: UTF-8, UTF-8 with a mark, or GBK, the first that reads."""

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [None if c is None else _decode(c)[0] for c in batch["content"]]
            reason = [TOO_LARGE if c is None else "ok" if e else "encoding not recognised, save as UTF-8" for c, e in zip(batch["content"], found)]
            yield pd.DataFrame({"path": batch["path"], "encoding": found, "reason": reason})

    return files.select("path", _content()).mapInPandas(detect, "path string, encoding string, reason string")


def read_sales_files(files: DataFrame) -> DataFrame:
    """Rows of many small files, each with its own encoding and column order, as text columns plus `path`.

    Columns a file lacks are NULL. A file that cannot be read yields one row with its `reason`.
    """
    schema = ", ".join(["path string", "reason string", *[f"{c} string" for c in RAW_COLUMNS]])

    def rows_of(path: str, content: bytes | None) -> pd.DataFrame:
        if content is None:
            return pd.DataFrame({"path": [path], "reason": [TOO_LARGE]})
        encoding, text = _decode(content)
        if encoding is None:
            return pd.DataFrame({"path": [path], "reason": ["encoding not recognised, save as UTF-8"]})
        try:
            table = pd.read_csv(io.StringIO(text), dtype=str, keep_default_na=False, na_values=list(NULL_MARKERS))
        except (pd.errors.ParserError, pd.errors.EmptyDataError, csv.Error) as e:
            return pd.DataFrame({"path": [path], "reason": [f"not a readable CSV: {e}"]})
        return table.assign(path=path, reason="ok")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield rows_of(path, content).reindex(columns=["path", "reason", *RAW_COLUMNS]).astype(object).where(lambda t: t.notna(), None)

    return files.select("path", _content()).mapInPandas(read, schema)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The event calendar; no file means no events."""
    try:
        df = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "date date, type string, locale string, description string, transferred boolean")
    return df.select(
        to_day(F.col("date")).alias("date"), "type", "locale", "description", (F.lower("transferred") == "true").alias("transferred")
    )


def extract_subset(df: DataFrame, path: str, stores: Sequence[int] = TARGET_STORES) -> DataFrame:
    """Write the rows of some stores in store, family, date order (ranges, so a large store is split)."""
    keys = ["store_nbr", "family", "date"]
    df.filter(F.col("store_nbr").isin(*stores)).repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_session(df: DataFrame, path: str, session_id: str) -> None:
    """Replace this session's partition and leave the others; a repeated write gives the same table."""
    out = df.withColumn("session_id", F.lit(session_id)).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("session_id").parquet(path)


def load_session(spark: SparkSession, path: str, session_id: str) -> DataFrame:
    """One session of a saved table. Only its folder is listed, and its own columns are its schema."""
    if not re.fullmatch(r"[\w.\-]+", session_id):
        raise ValueError(f"not a session id: {session_id!r}")
    return spark.read.parquet(f"{path}/session_id={session_id}")


def write_summary(df: DataFrame, path: str, session_id: str, observed: dict[str, int] | None = None) -> None:
    """The dataset summary as one JSON document, with what was observed of the raw rows, if given."""
    summary = dataset_summary(df, observed)
    row = summary.select(
        F.lit(session_id).alias("session_id"), F.current_timestamp().alias("created_at"), F.struct(*summary.columns).alias("summary")
    )
    row.write.mode("overwrite").json(path)


def export_forecast(results: DataFrame) -> DataFrame:
    """Arrays per model to rows date, model, forecast, lower_ci, upper_ci, cut to the shortest array.

    A model without intervals has NULL arrays and gets NULL bounds.
    """
    bound = lambda c: F.coalesce(F.col(c), F.transform("dates", lambda _: F.lit(None).cast("double")))
    arrays = {"date": F.col("dates"), "forecast": F.col("forecast"), "lower_ci": bound("lower_ci"), "upper_ci": bound("upper_ci")}
    shortest = F.least(*[F.size(a) for a in arrays.values()])
    zipped = F.arrays_zip(*[F.slice(a, F.lit(1), shortest).alias(n) for n, a in arrays.items()])
    keys = [c for c in results.columns if c not in ("dates", "forecast", "lower_ci", "upper_ci")]
    return results.select(*keys, zipped.alias("z")).select(*keys, F.inline("z"))


def write_forecast(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
