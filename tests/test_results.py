"""Requests and stored results: reuse, settings, refusals, repeated writes."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from shelfcast.operators import results as rs
from shelfcast.sources.scratch import scratch_path, snapshot

ASK = "request_id long, family string, store_nbr int, horizon int, models array<string>, configs map<string,string>, note string"


@pytest.fixture
def store(spark):
    return scratch_path(spark, "store")


@pytest.fixture
def small(spark, panel):
    rows = [(i, s, f, 20 + 5 * math.sin(i / 7 * 2 * math.pi) + 0.02 * i + s) for i in range(120) for s in (1, 2) for f in ("A", "B")]
    return snapshot(panel([*rows, *[(i, 3, "A", 5.0) for i in range(20)]]), "small")


@pytest.fixture
def events(spark):
    return spark.createDataFrame([(dt.date(2020, 2, 3), "Holiday", "National", "Day", False)], "date date, type string, locale string, description string, transferred boolean")


def ask(spark, *rows):
    return spark.createDataFrame([(*r, *([None] * (6 - len(r))), "x") for r in rows], ASK)


def test_requests_get_their_part(spark, small, events, store):
    requests = ask(
        spark, (1, "A", 1, 7, ["ARIMA", "LSTM", "ARIMA"]), (2, "A", 1, 90, ["Prophet"]), (3, "A", 9, 30, ["ARIMA"]), (4, "A", 3, 30, ["ARIMA"]), (5, "B", 2, 91, ["ARIMA"]),
        (6, "B", 2, 30, []), (7, None, 2, 30, ["ARIMA"]), (8, "B", 2, 30, ["ARIMA"], {"ARIMA": '{"criterion":"best"}'}), (9, "B", 2, 30, ["ARIMA"], {"ARIMA": '{"criterion":"bic"}'}),
        (10, "B", 2, 30, None), (11, "B", 2, 30, ["ARIMA", "X"]),
    )
    answers = rs.answer_requests(requests, small, events, store)
    assert {r.request_id: r.reason for r in answers.status.collect()} == {
        1: "ok", 2: "ok", 3: "store unknown", 4: "series too short", 5: "horizon out of range", 6: "no model chosen", 7: "family missing", 8: "setting not supported", 9: "ok",
        10: "no model chosen", 11: "model not supported",
    }
    rows = answers.forecasts.collect()
    assert {(r.request_id, r.model) for r in rows} == {(1, "ARIMA"), (1, "LSTM"), (2, "Prophet"), (9, "ARIMA")}
    assert sum(r.request_id == 1 for r in rows) == 14 and sum(r.request_id == 2 for r in rows) == 90
    assert min(r.date for r in rows) == dt.date(2020, 1, 1) + dt.timedelta(days=120) and all(r.forecast >= 0 for r in rows)
    ranks = {(r.request_id, r.model): r["rank"] for r in answers.ranking.collect()}
    assert sorted(ranks[1, m] for m in ("ARIMA", "LSTM")) == [1, 2] and ranks[2, "Prophet"] == 1
    names = {(r.request_id, r.name) for r in answers.chart.collect()}
    assert {n for i, n in names if i == 1} == {"actual", "ARIMA", "LSTM"}


def test_second_run_fits_nothing(spark, small, events, store, monkeypatch):
    requests = rs.request_everything(small, 14)
    first = sorted(rs.answer_requests(requests, small, events, store).forecasts.drop("cache_hit").collect())
    monkeypatch.setattr(rs, "fit_model", lambda *a: pytest.fail("fitted again"))
    again = rs.answer_requests(requests, small.repartition(3), events, store).forecasts
    assert sorted(again.drop("cache_hit").collect()) == first and len(first) == 4 * 3 * 14
    assert again.filter("not cache_hit").count() == 0


def test_only_what_changed_is_fitted(spark, small, events, store, monkeypatch):
    rs.answer_requests(ask(spark, (1, "A", 1, 7, ["ARIMA"]), (2, "B", 1, 7, ["ARIMA"])), small, events, store)
    seen, fit = [], rs.fit_model
    monkeypatch.setattr(rs, "fit_model", lambda *a: seen.append((a[0], a[1], sorted((r.family, r.store_nbr) for r in a[4].collect()))) or fit(*a))
    changed = small.selectExpr("date", "store_nbr", "family", "if(family = 'B' and date = '2020-01-05', sales + 1, sales) as sales", "onpromotion")
    rs.answer_requests(ask(spark, (1, "A", 1, 7, ["ARIMA"]), (2, "B", 1, 30, ["ARIMA"])), snapshot(changed, "changed"), events, store)
    assert seen == [("ARIMA", '{"criterion":"aic"}', [("B", 1)])]
    rs.answer_requests(ask(spark, (3, "A", 1, 7, ["ARIMA"], {"ARIMA": '{"criterion":"bic"}'})), small, events, store)
    assert seen[1:] == [("ARIMA", '{"criterion":"bic"}', [("A", 1)])]


def test_a_repeated_write_replaces_its_partition(spark, small, events, store):
    wanted = rs.fc.series_fingerprint(small.filter("family = 'A' and store_nbr = 1")).selectExpr("'ARIMA' as model", "family", "store_nbr", "fingerprint", "'{\"criterion\":\"aic\"}' as config")
    empty, read = scratch_path(spark, "nothing"), rs.read_results
    rs.ensure_results(wanted, small, events, store)
    try:  # a run that started before the first one ended sees an empty store
        rs.read_results = lambda s, path, calls=[]: read(s, empty if not calls.append(1) and len(calls) == 1 else path)
        rs.ensure_results(wanted, small, events, store)
    finally:
        rs.read_results = read
    assert spark.read.parquet(store).count() == 1


def test_nothing_accepted(spark, small, events, store):
    answers = rs.answer_requests(ask(spark, (1, "A", 9, 30, ["ARIMA"])), small, events, store)
    assert answers.forecasts.count() == answers.ranking.count() == answers.chart.count() == 0 and answers.status.count() == 1
