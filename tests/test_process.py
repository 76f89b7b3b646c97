from __future__ import annotations

import datetime as dt
import os

import pytest

from shelfcast.operators import analysis
from shelfcast.operators.aggregate import dataset_summary
from shelfcast.plans.process import process, process_report
from shelfcast.sources import files


@pytest.fixture
def empty_calendar(spark):
    return spark.createDataFrame([], "date date, type string, locale string, description string, transferred boolean")


def land(tmp_path, rows, header="date,store_nbr,family,sales,onpromotion"):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([header, *rows]) + "\n")
    return str(tmp_path / "in")


def days(n):
    return [str(dt.date(2020, 1, 1) + dt.timedelta(days=i)) for i in range(n)]


def test_upload_is_cleaned_saved_and_ready_for_analysis(spark, tmp_path, empty_calendar):
    path = land(tmp_path, [f"{d},1,A,{-5 if i % 15 == 0 else '' if i % 20 == 0 else i},0" for i, d in enumerate(days(100))] + [f"{days(1)[0]},1,A,7,2"])
    out = str(tmp_path / "out")
    panel = process(spark, files.read_sales_csv(spark, path), empty_calendar, out, "s1")
    got = panel.orderBy("date").collect()
    assert len(got) == 100 and (got[0]["sales"], got[0]["onpromotion"]) == (2.0, 2) and all(r["sales"] >= 0 for r in got)
    total = sum(r["sales"] for r in got)
    for name in ("daily_total", "by_family", "by_store"):
        saved = files.load_session(spark, f"{out}/{name}", "s1")
        assert sum(r["sales" if name == "daily_total" else "total_sales"] for r in saved.collect()) == total
    assert spark.read.json(f"{out}/summary/s1").first()["summary"]["total_rows"] == 100
    assert analysis.trend(panel, "monthly").count() == 4


def test_summary_says_what_was_seen_of_the_raw_rows(spark, tmp_path, empty_calendar):
    rows = ["2020-01-01,1,A,-5,0", "2020-01-01,1,A,x,-2", "2020-01-02,2,A,3,0", "2020-01-02,,A,4,0", "2020-01-03,1,B,NaN,0"]
    panel, summary = process_report(spark, files.read_sales_csv(spark, land(tmp_path, rows)), empty_calendar, str(tmp_path / "out"), "s1")
    got = summary.first()
    assert panel.count() == got["total_rows"] == 3 and (got["missing_before"], got["missing_after"]) == (2, 0)
    assert got["completeness_rate"] == 3 / 12
    assert got["warnings"] == ["merged_rows (1)", "null_keys (1)", "negative_sales (1)", "negative_promo (1)", "missing_sales (2)", "incomplete_panel (9)", "short_history (3)"]
    assert got["session_id"] == "s1" and spark.read.json(str(tmp_path / "out" / "summary" / "s1")).count() == 1


def test_summary_of_a_panel_alone(panel):
    full = dataset_summary(panel([(d, s, f, 1) for d in range(100) for s in (1, 2) for f in "AB"])).first()
    assert (full["missing_before"], full["completeness_rate"], full["warnings"]) == (None, 1.0, [])
    empty = dataset_summary(panel([(0, 1, "A", 1)]).limit(0)).first()
    assert empty["completeness_rate"] is None and empty["warnings"] == ["short_history (0)"]


@pytest.mark.parametrize(
    ("rows", "header", "reason"),
    [
        (["2020-01-01,1,A"], "date,store_nbr,family", "missing_column:sales"),
        (["2020-01-01,1,A,3,0", "soon,1,A,3,0"], "date,store_nbr,family,sales,onpromotion", r"bad_date \(1\)"),
        (["2020-01-01,S01,A,3,0", "2020-01-02,1.0,A,3,0"], "date,store_nbr,family,sales,onpromotion", r"bad_store \(1\)"),
        (["2020-01-01,1,A,x,0", "2020-01-02,1,A,NaN,0"], "date,store_nbr,family,sales,onpromotion", "no_numeric_sales"),
    ],
)
def test_invalid_upload_saves_nothing(spark, tmp_path, empty_calendar, rows, header, reason):
    out = tmp_path / "out"
    with pytest.raises(ValueError, match=reason):
        process(spark, files.read_sales_csv(spark, land(tmp_path, rows, header)), empty_calendar, str(out), "s1")
    assert not os.path.exists(out)
