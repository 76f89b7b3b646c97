"""What the plans of the lazy queries must and must not contain."""

from __future__ import annotations

import pytest

from shelfcast.operators import analysis as an
from shelfcast.operators import validate as va
from shelfcast.plans.sales_queries import QUERIES
from shelfcast.sources.tables import raw_text, sales_panel

EAGER = ("analysis_report", "monthly_comparison")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in EAGER])
def test_no_cross_join(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, sf, tmp_path):
    path = str(tmp_path / "panel")
    sales_panel(spark, sf).write.parquet(path)
    text = plan(an.trend(spark.read.parquet(path), "monthly", "PROMO", 3))
    assert "EqualTo(family,PROMO)" in text and "EqualTo(store_nbr,3)" in text
    assert "onpromotion" not in text


@pytest.mark.parametrize("query", [lambda s, d: va.validation_report(raw_text(s, d)), lambda s, d: an.overview(sales_panel(s, d)), lambda s, d: va.profile_raw(raw_text(s, d))])
def test_one_scan_of_the_fact_table(spark, sf, query):
    assert plan(query(spark, sf)).count("lineitem.parquet") == 1


def test_the_fact_table_is_never_broadcast(spark, sf):
    text = plan(sales_panel(spark, sf))
    for part in text.split("BroadcastExchange")[1:]:
        branch = part.split("FileScan parquet")[1]
        assert "l_suppkey" not in branch.split("ReadSchema")[1].split(">")[0]
