"""All registered queries and the SQL that states the same result."""

from __future__ import annotations

from shelfcast.plans import file_queries, file_sql, forecast_queries, forecast_sql, sales_queries, sales_sql


def queries():
    return {**sales_queries.QUERIES, **file_queries.QUERIES, **forecast_queries.QUERIES}


def oracles():
    return {**sales_sql.ORACLES, **file_sql.ORACLES, **forecast_sql.ORACLES}
