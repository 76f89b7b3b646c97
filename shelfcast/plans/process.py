"""The upload path as one call: check, clean, save, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.aggregate import by_family, by_store, daily_total
from shelfcast.operators.clean import handle_outliers, merged_panel
from shelfcast.operators.validate import missing_columns, observed_errors, observed_facts, require_observed
from shelfcast.sources.files import load_session, write_session, write_summary
from shelfcast.sources.scratch import snapshot


def process(spark: SparkSession, raw: DataFrame, calendar: DataFrame, out: str, session_id: str) -> DataFrame:
    """Raises on invalid input before anything is saved under `out`; returns the saved panel. See `process_report`."""
    return process_report(spark, raw, calendar, out, session_id)[0]


def process_report(spark: SparkSession, raw: DataFrame, calendar: DataFrame, out: str, session_id: str) -> tuple[DataFrame, DataFrame]:
    """The saved panel and its saved summary, one row, with warnings. Raises on invalid input before anything is saved under `out`.

    The raw rows are read once: the checks are counted while the merged panel, one row per key, is
    written. Spikes, totals and summary work on that smaller table.
    """
    missing = missing_columns(raw)
    if missing:
        raise ValueError("; ".join(f"missing_column:{c}" for c in missing))
    watched, facts = observed_errors(raw)
    merged = snapshot(merged_panel(watched), "merged")
    require_observed(facts)
    write_session(handle_outliers(merged, calendar), f"{out}/clean", session_id)
    panel = load_session(spark, f"{out}/clean", session_id)
    write_session(daily_total(panel), f"{out}/daily_total", session_id)
    write_session(by_family(panel), f"{out}/by_family", session_id)
    write_session(by_store(panel), f"{out}/by_store", session_id)
    write_summary(panel, f"{out}/summary/{session_id}", session_id, observed_facts(facts))
    return panel, spark.read.json(f"{out}/summary/{session_id}").select("session_id", "created_at", "summary.*")
