"""Lines of CSV files to raw sales rows, whatever the encoding, order of columns and size of each file."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.values import missing_text_to_null
from shelfcast.schema import RAW_COLUMNS
from shelfcast.sources.scratch import snapshot

UNKNOWN_ENCODING = "encoding not recognised, save as UTF-8"
ODD_QUOTES = "line break or single quote mark inside a cell"
TOO_WIDE = "rows with more cells than the header"

#: Lets `decode` read GBK, and mark what it cannot read instead of failing the batch.
_CHARSETS = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
_UNREADABLE = "�"


@contextmanager
def all_charsets(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in _CHARSETS}
    for key in _CHARSETS:
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def named_rows(lines: DataFrame) -> DataFrame:
    """Raw sales rows from the lines of CSV files (session_id, file_size, block_start, place, value), columns found by name.

    `place` grows with the lines of a block. Each file brings its own header and is UTF-8 (with or without a mark) or
    GBK, found from all its lines. Columns that a file lacks are NULL. The facts about the file come along: names,
    odd_text (neither encoding), odd_quotes (a line break inside quotes), too_wide (more cells than names). A file with
    nothing but its header yields one row of NULLs. Splittable: the file is read by as many tasks as it has blocks.
    """
    first = F.min(F.when(F.col("block_start") == 0, F.struct("place", F.col("value").alias("line"))))
    heads = lines.groupBy("session_id").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), first.alias("head"))
    heads = snapshot(heads, "landed-heads")  # one row a file; the lines are scanned once for it
    widest = heads.agg(F.max(F.size(F.split(F.col("head.line"), ",")))).first()[0] or 0
    schema = ", ".join(f"c{i} string" for i in range(widest + 1))

    def text(value: str) -> F.Column:
        return F.when(F.col("utf8"), F.col(value)).otherwise(F.decode(F.col(value).cast("binary"), "GBK"))

    def cells(value: F.Column) -> F.Column:
        return F.from_csv(value, schema, {"escape": '"'})

    def listed(struct: str) -> F.Column:
        return F.array(*[F.col(f"{struct}.c{i}") for i in range(widest + 1)])

    known = (
        heads.withColumn("cells", cells(F.regexp_replace(text("head.line"), "^﻿", "")))
        .withColumn("names", F.transform(F.array_compact(listed("cells")), lambda c: F.trim(c)))
        .select("session_id", "utf8", "names", F.col("head.place").alias("head_place"))
    )
    rows = (
        lines.join(known, "session_id")
        .withColumn("text", text("value"))
        .withColumn("is_head", (F.col("place") == F.col("head_place")) & (F.col("block_start") == 0))
        .filter("is_head or trim(text) <> ''")
        .withColumn("cells", cells(F.when(~F.col("is_head"), F.col("text"))))
        .withColumn("listed", listed("cells"))
    )
    cell = lambda c: F.try_element_at("listed", F.nullif(F.array_position("names", c), F.lit(0)).cast("int"))
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"')))
    extra = F.try_element_at("listed", F.size("names") + 1)
    return rows.select(
        *[missing_text_to_null(cell(c)).alias(c) for c in RAW_COLUMNS],
        "session_id",
        "file_size",
        "utf8",
        "names",
        "is_head",
        F.contains("text", F.lit(_UNREADABLE)).alias("odd_text"),
        (quotes % 2 == 1).alias("odd_quotes"),
        F.coalesce(extra.isNotNull(), F.lit(False)).alias("too_wide"),
    )


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """(path, encoding, reason, raw columns) of the CSV files under a folder, of any size, each with its own encoding and header.

    Splittable: a file is read by as many tasks as it has blocks, once to find encoding and header and once for its rows. Columns that a
    file lacks are NULL, as are missing markers. `reason` is 'ok', or says what is wrong with this line (no encoding reads it, an
    odd number of quote marks, more cells than the header); such lines are kept with what could be read. A file with nothing but
    its header gives no rows.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("session_id"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("place"),  # both scans split the files alike
    )
    with all_charsets(spark):  # the setting becomes part of the expressions
        rows = named_rows(lines)
    reason = F.when(F.col("odd_text"), UNKNOWN_ENCODING).when(F.col("odd_quotes"), ODD_QUOTES).when(F.col("too_wide"), TOO_WIDE).otherwise("ok")
    encoding = F.when(F.col("utf8"), "utf-8").otherwise("gbk")
    return rows.filter("not is_head").select(F.col("session_id").alias("path"), encoding.alias("encoding"), reason.alias("reason"), *RAW_COLUMNS)
