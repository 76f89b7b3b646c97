"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.scratch import scratch_path

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends here and survives lost executors.

    options: of the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc(column: Column) -> Column:
    """crc32 of a value's text, null as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def texts(rows: pa.RecordBatch | pa.StructArray, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column, or of a field of structs; null is empty."""
    column = rows.field(name) if isinstance(rows, pa.StructArray) else rows.column(name)
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mapped(rows: Callable[[pa.RecordBatch], dict], schema: pa.Schema, at_once: int = 500) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that makes columns from each batch, a few rows at a time, since texts can be long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, at_once):
                yield pa.RecordBatch.from_pydict(rows(batch.slice(i, at_once)), schema=schema)

    return run


@contextmanager
def small_batches(spark: SparkSession, records: int = 500) -> Iterator[None]:
    """Jobs run inside hand rows to Python in batches of few records, since texts can be long; the setting is put back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(records))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_enough(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """Mark a side for broadcast if its counted rows need at most `limit` bytes; else leave the join to Spark."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs whose results are written: it does once the driver has collected their plans.

    Between the rounds of a long job that would wait for the driver's next full collection, with the files of all rounds on disk.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
