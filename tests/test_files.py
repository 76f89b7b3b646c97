from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import clean as cl
from shelfcast.sources import files
from shelfcast.sources.landed import read_landed
from shelfcast.streaming.ingest import commit_batch, ingest_stream, read_ledger

HEADER = "date,store_nbr,family,sales,onpromotion\n"


def body(n=100, family="饮料", sales=None):
    day = dt.date(2020, 1, 1)
    return HEADER + "".join(f"{day + dt.timedelta(days=i)},1,{family},{sales if sales is not None else 100 + i},0\n" for i in range(n))


@pytest.fixture
def empty_calendar(spark):
    return spark.createDataFrame([], "date date, type string, locale string, description string, transferred boolean")


def test_encodings_and_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(body().encode("utf-8"))
    (tmp_path / "b.csv").write_bytes(body().encode("utf-8-sig"))
    (tmp_path / "c.csv").write_bytes(body().encode("gbk"))
    (tmp_path / "d.csv").write_bytes(b"\xff\xfe\x00\x81\xff")
    found = files.list_files(spark, str(tmp_path), content=True)
    got = {r["path"][-5:]: r["encoding"] for r in files.detect_encoding(found).collect()}
    assert got == {"a.csv": "utf-8", "b.csv": "utf-8", "c.csv": "gbk", "d.csv": None}
    rows = files.read_sales_files(found).collect()
    for name in "abc":
        mine = [r for r in rows if r["path"].endswith(f"{name}.csv")]
        assert len(mine) == 100 and {r["family"] for r in mine} == {"饮料"} and mine[0]["date"] == "2020-01-01"
    assert [r["reason"] for r in rows if r["path"].endswith("d.csv")] == ["encoding not recognised, save as UTF-8"]


def test_a_large_gbk_file_is_read_by_many_tasks(spark, tmp_path):
    line = "2020-01-01,1,饮料和酒类及其他,{},0,备注\n".encode("gbk")
    with open(tmp_path / "big.csv", "wb") as f:
        f.write("date,store_nbr,family,sales,onpromotion,备注\n".encode("gbk"))
        for i in range(1200):
            f.write(b"".join(line.replace(b"{}", str(i * 1000 + j).encode()) for j in range(1000)))
    assert (tmp_path / "big.csv").stat().st_size > 40_000_000
    rows = read_landed(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() > 1
    got = rows.groupBy("encoding", "reason", "family").agg(F.count("*").alias("n"), F.sum(F.col("sales").cast("long")).alias("s")).collect()
    assert [tuple(r) for r in got] == [("gbk", "ok", "饮料和酒类及其他", 1_200_000, sum(range(1_200_000)))]


def test_landed_lines_that_cannot_be_read_say_so(spark, tmp_path):
    (tmp_path / "a.csv").write_text('sales,date\n"4",2020-01-01\n5,2020-01-02,6\n"7,2020-01-03\n\n')
    (tmp_path / "b.csv").write_bytes(b"sales,date\n\xff\xff\x81,2020-01-04\n")
    (tmp_path / "c.csv").write_text(HEADER)
    (tmp_path / "d.csv").write_bytes("\ufeffdate,sales\n2020-01-05,NaN\n".encode())
    got = {r["date"] or "-": (r["path"][-5:], r["encoding"], r["reason"], r["sales"], r["family"]) for r in read_landed(spark, str(tmp_path)).collect()}
    assert got["2020-01-01"] == ("a.csv", "utf-8", "ok", "4", None)
    assert got["2020-01-02"][2] == "rows with more cells than the header"
    assert got["2020-01-04"][:3] == ("b.csv", "gbk", "encoding not recognised, save as UTF-8")
    assert got["2020-01-05"] == ("d.csv", "utf-8", "ok", None, None)
    assert [v[2] for v in got.values()].count("line break or single quote mark inside a cell") == 1 and len(got) == 5


def test_a_broken_table_reports_its_real_cause(spark, tmp_path):
    (tmp_path / "x.csv").write_text('date,sales\n"2020-01-01,1\n2020-01-02,2,3,4\n')
    (tmp_path / "y.csv").write_text("\n")
    rows = files.read_sales_files(files.list_files(spark, str(tmp_path), content=True)).collect()
    assert len(rows) == 2 and all(r["reason"].startswith("not a readable CSV") for r in rows)


def test_gate(spark, tmp_path):
    for name in ("ok.csv", "UPPER.CSV", "old.xls", "new.xlsx", "notes.txt"):
        (tmp_path / name).write_text("x")
    with open(tmp_path / "big.csv", "wb") as f:
        f.truncate(16 * 1024 * 1024 + 1)
    got = {r["path"].rsplit("/", 1)[1]: (r["accepted"], r["reason"]) for r in files.file_gate(files.list_files(spark, str(tmp_path))).collect()}
    assert got["ok.csv"] == got["UPPER.CSV"] == (True, "ok")
    assert {n: r for n, (a, r) in got.items() if not a} == {
        "old.xls": "save .xls as .xlsx or CSV first", "new.xlsx": "land .xlsx as CSV or Parquet", "notes.txt": "file type not supported", "big.csv": "file larger than 16 MB",
    }


def test_gate_reads_no_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    plan = files.file_gate(files.list_files(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "content:binary" not in plan


def test_missing_markers_and_spare_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,date,store_nbr,family,sales\n1,2020-01-01,1,A,NaN\n2,2020-01-02,1,A,\n3,2020-01-03,1,A,4\n")
    df = files.read_sales_csv(spark, str(tmp_path))
    assert df.columns == ["id", "date", "store_nbr", "family", "sales"]
    assert [r["sales"] for r in df.orderBy("id").collect()] == [None, None, "4"]
    assert cl.merge_duplicates(cl.coerce_types(df)).columns == ["date", "family", "store_nbr", "sales"]


def test_calendar_file_or_none(spark, tmp_path):
    path = tmp_path / "holidays.csv"
    path.write_text("date,type,locale,locale_name,description,transferred\n2020-05-01,Holiday,National,X,May,False\n2020-06-01,Holiday,National,X,June,True\nbad,Event,Local,X,Odd,False\n")
    assert [str(r["date"]) for r in cl.load_events(files.read_calendar(spark, str(path))).collect()] == ["2020-05-01"]
    assert files.read_calendar(spark, str(tmp_path / "none.csv")).count() == 0


def test_sessions_replace_only_themselves(spark, one, tmp_path):
    path = str(tmp_path / "clean")
    files.write_session(one([1.0, 2.0]), path, "a")
    files.write_session(one([5.0], promo=False), path, "b")
    files.write_session(one([7.0, 8.0, 9.0]), path, "a")
    assert sorted(r["sales"] for r in files.load_session(spark, path, "a").collect()) == [7.0, 8.0, 9.0]
    loaded = files.load_session(spark, path, "b")
    assert loaded.count() == 1 and "onpromotion" not in loaded.columns and "session_id" not in loaded.columns
    with pytest.raises(ValueError):
        files.load_session(spark, path, "../a")


def test_summary_document(spark, one, tmp_path, empty_calendar):
    path = str(tmp_path / "summary")
    files.write_summary(cl.clean(one([1.0] * 6 + [500.0] + [1.0] * 6), empty_calendar), path, "s")
    r = spark.read.json(path).first()
    assert r["session_id"] == "s" and r["summary"]["outliers_replaced"] == 1 and r["summary"]["families"][0]["total_sales"] == 13.0


def test_subset_is_sorted(spark, panel, tmp_path):
    df = panel([(i % 5, s, f, i) for i, (s, f) in enumerate([(2, "B"), (1, "B"), (3, "A"), (1, "A"), (2, "A")] * 4)])
    got = files.extract_subset(df, str(tmp_path / "subset"), (1, 2))
    assert {r["store_nbr"] for r in got.collect()} == {1, 2} and got.columns == df.columns


def test_export_cuts_to_the_shortest_array(spark):
    days = [dt.date(2020, 1, d) for d in (1, 2, 3)]
    rows = [("ARIMA", days, [1.0, 2.0, 3.0], [0.0, 0.0], [9.0, 9.0, 9.0]), ("LSTM", days, [4.0, 5.0, 6.0], None, None)]
    df = spark.createDataFrame(rows, "model string, dates array<date>, forecast array<double>, lower_ci array<double>, upper_ci array<double>")
    got = [tuple(r) for r in files.export_forecast(df).orderBy("model", "date").collect()]
    assert got == [("ARIMA", days[0], 1.0, 0.0, 9.0), ("ARIMA", days[1], 2.0, 0.0, 9.0)] + [("LSTM", d, v, None, None) for d, v in zip(days, (4.0, 5.0, 6.0))]


def test_stream_cleans_each_file_as_a_session(spark, tmp_path, empty_calendar):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()
    (landing / "first.csv").write_text(body(10, "A") + "2020-01-01,1,A,5,0\n")
    (landing / "broken.csv").write_text(body(3, "B") + "someday,1,B,5,0\n")
    (landing / "notes.txt").write_text("no table")
    run = lambda: ingest_stream(spark, str(landing), out, state, empty_calendar, files_per_batch=1)
    run()
    (landing / "second.csv").write_text(body(4, "A", -3))
    run()
    run()  # nothing new
    got = {r["session_id"]: (r["n"], r["s"]) for r in spark.read.parquet(f"{out}/clean").groupBy("session_id").agg({"*": "count", "sales": "sum"}).toDF("session_id", "n", "s").collect()}
    assert got == {"first": (10, 5 + sum(100 + i for i in range(10))), "second": (4, 0.0)}
    verdicts = {r["session_id"]: r["reason"] for r in spark.read.parquet(f"{out}/verdicts").collect()}
    assert verdicts == {"first": "ok", "second": "ok", "broken": "unreadable dates"}


def test_a_repeated_batch_is_told_from_a_file_that_lands_again(spark, tmp_path, empty_calendar):
    out, text = str(tmp_path / "out"), lambda s: [x for x in s.splitlines()]
    lines = lambda *files_: spark.createDataFrame([(line, name, 9, 0) for name, content in files_ for line in text(content)], "value string, session_id string, file_size long, block_start long").coalesce(1)
    total = lambda: {r[0]: r[1] for r in spark.read.parquet(f"{out}/clean").groupBy("session_id").sum("sales").collect()}
    seen = lambda: sorted((r.session_id, r.landing, r.reason, r.rows, r.stream, r.batch_id) for r in read_ledger(spark, out).collect())
    assert seen() == []
    first = lines(("a", body(3, "A", 5)), ("b", body(2, "A", 1)))
    assert commit_batch(first, 0, "s", out, empty_calendar)
    assert not commit_batch(first, 0, "s", out, empty_calendar) and total() == {"a": 15.0, "b": 2.0}
    assert commit_batch(lines(("a", body(3, "A", 7))), 1, "s", out, empty_calendar) and total() == {"a": 21.0, "b": 2.0}
    assert commit_batch(lines(("a", HEADER + "soon,1,A,5,0\n")), 0, "t", out, empty_calendar) and total() == {"a": 21.0, "b": 2.0}
    assert seen() == [("a", 1, "ok", 3, "s", 0), ("a", 2, "ok", 3, "s", 1), ("a", 3, "unreadable dates", 1, "t", 0), ("b", 1, "ok", 2, "s", 0)]


def test_large_files_get_a_reason_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MAX_FILE_BYTES", 60)
    (tmp_path / "small.csv").write_text("date,store_nbr,family,sales\n2020-01-01,1,A,2\n")
    (tmp_path / "big.csv").write_text("date,store_nbr,family,sales\n" + "2020-01-01,1,A,2\n" * 9)
    listed = files.list_files(spark, str(tmp_path), content=True)
    found = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in files.detect_encoding(listed).collect()}
    assert found == {"small.csv": "ok", "big.csv": files.TOO_LARGE}
    assert {r["path"].rsplit("/", 1)[1]: r["reason"] for r in files.read_sales_files(listed).collect()} == found


def test_days_need_a_sensible_year(spark):
    from pyspark.sql import functions as F

    from shelfcast.functions.values import to_day

    df = spark.createDataFrame([("12961",), ("1296",), ("2020-02-29",)], "d string")
    assert [r[0] is None for r in df.select(to_day(F.col("d"))).collect()] == [True, True, False]


def test_stream_finds_columns_by_name_and_reads_gbk(spark, tmp_path, empty_calendar):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    rows = [f"2020-01-{d:02d}" for d in range(1, 11)]
    tables = {
        "promo_first": ("date,store_nbr,family,onpromotion,sales", [f"{d},1,饮料,7,{50 + i}" for i, d in enumerate(rows)], "utf-8"),
        "with_id": ("id,date,store_nbr,family,sales,onpromotion", [f"{i},{d},1.0,饮料,{50 + i},7" for i, d in enumerate(rows)], "utf-8-sig"),
        "turned": ("family,sales,date,store_nbr", [f'"饮料","{50 + i}",{d},1' for i, d in enumerate(rows)], "gbk"),
        "no_sales": ("date,store_nbr,family,price,onpromotion", [f"{d},1,饮料,9,0" for d in rows], "utf-8"),
        "text_store": ("date,store_nbr,family,sales", [f"{d},S01,饮料,9" for d in rows], "utf-8"),
        "wide": ("date,store_nbr,family,sales", [f"{d},1,饮料,9,8,7" for d in rows], "utf-8"),
        "quoted": ("date,store_nbr,family,sales", [f'{d},1,"饮\n料",9' for d in rows], "utf-8"),
        "only_header": ("date,store_nbr,family,sales", [], "utf-8"),
    }
    for name, (header, body_rows, encoding) in tables.items():
        (landing / f"{name}.csv").write_bytes(("\n".join([header, *body_rows]) + "\n\n").encode(encoding))
    (landing / "other.csv").write_bytes(b"date,store_nbr,family,sales\n2020-01-01,1,\xff\xff\x81,3\n")
    ingest_stream(spark, str(landing), out, str(tmp_path / "state"), empty_calendar)
    verdicts = {r["session_id"]: r["reason"] for r in spark.read.parquet(f"{out}/verdicts").collect()}
    assert verdicts == {
        "promo_first": "ok", "with_id": "ok", "turned": "ok", "no_sales": "missing columns: sales", "text_store": "unreadable stores",
        "wide": "rows with more cells than the header", "quoted": "line break or single quote mark inside a cell",
        "only_header": "no numeric sales", "other": "encoding not recognised, save as UTF-8",
    }
    got = {(r["session_id"], r["family"]): (r["sales"], r["promo"]) for r in spark.read.parquet(f"{out}/clean").groupBy("session_id", "family").agg({"sales": "sum", "onpromotion": "sum"}).toDF("session_id", "family", "a", "b").selectExpr("session_id", "family", "greatest(a, b) as sales", "least(a, b) as promo").collect()}
    assert got == {("promo_first", "饮料"): (545.0, 70.0), ("with_id", "饮料"): (545.0, 70.0), ("turned", "饮料"): (545.0, 0.0)}


def test_stream_size_limit_is_a_choice(spark, tmp_path, empty_calendar):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    (landing / "a.csv").write_text(body(10, "A"))
    ingest_stream(spark, str(landing), out, str(tmp_path / "state"), empty_calendar, max_bytes=20)
    assert [r["reason"] for r in spark.read.parquet(f"{out}/verdicts").collect()] == ["file too large"]
