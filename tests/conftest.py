from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.schema import PANEL_SCHEMA  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def panel(spark):
    """Builds a panel from (date or day number, store, family, sales[, promo]) rows."""

    def build(rows, start="2020-01-01", promo=True):
        first = dt.date.fromisoformat(start)
        full = []
        for r in rows:
            day = first + dt.timedelta(days=r[0]) if isinstance(r[0], int) else dt.date.fromisoformat(r[0])
            full.append((day, r[1], r[2], None if r[3] is None else float(r[3]), r[4] if len(r) > 4 else 0))
        df = spark.createDataFrame(full, PANEL_SCHEMA)
        return df if promo else df.drop("onpromotion")

    return build


@pytest.fixture
def one(panel):
    """A single series (store 1, family A) from its daily values."""
    return lambda values, **kw: panel([(i, 1, "A", v) for i, v in enumerate(values)], **kw)


def column(df, name):
    return [r[name] for r in df.orderBy("date").collect()]
