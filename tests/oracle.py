"""Compare registered queries with their SQL statements on the test tables."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from tidemark.queries import ORACLES, QUERIES
from tidemark.queries.views import BASE_TABLES


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return value


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


# Row-at-a-time Python and joins of all pairs have no place in any plan.
UNWANTED = ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


def unwanted_operators(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [name for name in UNWANTED if name in plan]


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None if the results agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    if unwanted_operators(df):
        return f"plan with {unwanted_operators(df)}"
    ours = df.collect()
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    left, right = _sorted_rows(ours, df.columns), _sorted_rows(theirs, columns)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"first difference: {a} against {b} in {sorted(df.columns)}"
    return None if left else "no rows"


if __name__ == "__main__":
    from tests.conftest import make_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = make_session()
    connection = connect(sf_dir)
    failed = 0
    for name in QUERIES:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        if name in ORACLES:
            try:
                problem = compare(spark, connection, sf_dir, name)
            except Exception as error:  # noqa: BLE001
                problem = f"{type(error).__name__}: {str(error)[:1500]}"
        else:
            problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
