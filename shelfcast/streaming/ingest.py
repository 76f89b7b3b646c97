"""New sales files landing in a folder: checked, cleaned and appended, one session per file."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.values import to_day, to_number, to_store
from shelfcast.operators.clean import clean
from shelfcast.schema import RAW_COLUMNS, REQUIRED, SERIES
from shelfcast.sources.landed import ODD_QUOTES, TOO_WIDE, UNKNOWN_ENCODING, all_charsets, named_rows
from shelfcast.sources.scratch import snapshot

#: The commit ledger: one row per file and batch that has been saved; landing counts the batches that brought the session.
LEDGER = "session_id string, landing long, reason string, bytes long, rows long, stream string, batch_id long"

def session_verdicts(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Per session of `named_rows`: why its file is refused, or 'ok', its bytes and rows. Combines map-side; a large file is no hot spot."""
    unreadable = F.col("date").isNotNull() & to_day(F.col("date")).isNull()
    bad_store = F.col("store_nbr").isNotNull() & to_store(F.col("store_nbr")).isNull()
    facts = df.groupBy("session_id").agg(
        F.max("file_size").alias("bytes"),
        F.max(F.array_join(F.array_except(F.array(*[F.lit(c) for c in REQUIRED]), "names"), ", ")).alias("missing"),
        *[F.bool_or(c).alias(c) for c in ("odd_text", "odd_quotes", "too_wide")],
        F.count_if(unreadable).alias("bad_dates"),
        F.count_if(bad_store).alias("bad_stores"),
        F.count(to_number(F.col("sales"))).alias("numeric"),
        F.count_if(~F.col("is_head")).alias("rows"),
    )
    too_large = F.lit(False) if max_bytes is None else F.col("bytes") > max_bytes
    reason = (
        F.when(too_large, "file too large")
        .when(F.col("odd_text"), UNKNOWN_ENCODING)
        .when(F.col("odd_quotes"), ODD_QUOTES)
        .when(F.col("missing") != "", F.concat(F.lit("missing columns: "), "missing"))
        .when(F.col("too_wide"), TOO_WIDE)
        .when(F.col("bad_dates") > 0, "unreadable dates")
        .when(F.col("bad_stores") > 0, "unreadable stores")
        .when(F.col("numeric") == 0, "no numeric sales")
        .otherwise("ok")
    )
    return facts.select("session_id", reason.alias("reason"), "bytes", "rows")


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """The commit ledger of `out`, empty before the first batch. One small file a batch."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{out}/ledger")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def commit_batch(batch: DataFrame, batch_id: int, stream: str, out: str, calendar: DataFrame, max_bytes: int | None = None) -> bool:
    """Save one batch of lines under `out`; False if the ledger has it already, as when a stream repeats its last batch.

    A batch that fails on the way has no row in the ledger, which is written last; repeated, it overwrites the partitions of its own
    sessions. A file that lands again under its name is another batch: if accepted, it replaces the session, if refused, the
    rows saved before stay; the ledger has both landings. A batch reads its own verdicts, and of the ledger the rows of its sessions.
    """
    spark = batch.sparkSession
    ledger = read_ledger(spark, out)
    if not ledger.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
        return False

    def save(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session_id").parquet(f"{out}/{name}")

    with all_charsets(spark):  # lines are parsed once
        rows = snapshot(named_rows(batch.withColumn("place", F.monotonically_increasing_id())), "landed-rows")
    verdicts = snapshot(session_verdicts(rows, max_bytes), "verdicts")
    accepted = verdicts.where("reason = 'ok'").select("session_id")
    kept = rows.filter("not is_head").join(accepted, "session_id", "left_semi").select("session_id", *RAW_COLUMNS)
    save(clean(kept, calendar, series=("session_id", *SERIES)), "clean")
    save(verdicts.select("session_id", "reason"), "verdicts")
    before = ledger.join(verdicts.select("session_id"), "session_id", "left_semi").groupBy("session_id").agg(F.max("landing").alias("before"))
    landed = verdicts.join(before, "session_id", "left").select("session_id", (F.coalesce("before", F.lit(0)) + 1).alias("landing"), "reason", "bytes", "rows")
    landed.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/stream={stream}/batch_id={batch_id}")
    return True


def ingest_stream(
    spark: SparkSession, landing: str, out: str, checkpoint: str, calendar: DataFrame, files_per_batch: int = 1000, max_bytes: int | None = None
) -> None:
    """Process all files that are new since the last call.

    The file name is the session. Tables: `out`/clean, `out`/verdicts (the last word on each session) and `out`/ledger (every landing
    that was saved, see `commit_batch`). They stay the same after a retry. A file of 0 bytes has no verdict. A stream is known by
    the id in its checkpoint, so one that begins anew brings its files again.
    """
    lines = (
        spark.readStream.option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(landing)
        .select(
            "value",
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1).alias("session_id"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
    )

    stream: Future[str] = Future()
    writer = lines.writeStream.foreachBatch(lambda batch, batch_id: commit_batch(batch, batch_id, stream.result(), out, calendar, max_bytes))
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.set_result(str(query.id))
    query.awaitTermination()
