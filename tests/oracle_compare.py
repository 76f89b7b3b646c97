"""Runs registered queries beside their SQL: `python tests/oracle_compare.py [sf_dir] [key ...]`."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, datetime.datetime):
        return x.date().isoformat() if x.time() == datetime.time() else x.isoformat()
    return str(x)


def compare(spark, con, sf_dir, query, sql) -> list[str]:
    """Differences of rows, column names, column types and values; empty when equal."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    names = df.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    con.execute(f"create or replace temp table expected as {sql}")
    wanted = con.execute("select * from expected").fetchall()
    described = con.execute("describe expected").fetchall()
    w_names, w_types = [d[0] for d in described], {d[0]: d[1] for d in described}
    w_order = sorted(range(len(w_names)), key=lambda i: w_names[i])
    problems = []
    if sorted(names) != sorted(w_names):
        return [f"columns {sorted(names)} against {sorted(w_names)}"]
    for n, t in df.dtypes:
        if KINDS.get(t, t) != w_types[n]:
            problems.append(f"type of {n}: {t} against {w_types[n]}")
    got = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    exp = sorted(tuple(_cell(r[i]) for i in w_order) for r in wanted)
    if len(got) != len(exp):
        problems.append(f"rows {len(got)} against {len(exp)}")
    if got != exp:
        bad = [(a, b) for a, b in zip(got, exp) if a != b]
        problems.append(f"{len(bad)} of {len(exp)} rows differ, first {bad[:2]}")
    return problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from shelfcast.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    spark, con = local_session(), connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    keys = args or list(queries)
    failed = 0
    for key in keys:
        t0 = time.time()
        try:
            if key in oracles:
                problems = compare(spark, con, sf, queries[key], oracles[key])
                note = "" if not problems else "; ".join(problems)
            else:
                problems, note = [], f"rows only: {queries[key](spark, sf).count()}"
        except Exception as e:  # noqa: BLE001
            problems = note = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {key:28s} {time.time() - t0:6.2f}s {note}", flush=True)
    print(f"{len(keys) - failed} of {len(keys)} fine")
