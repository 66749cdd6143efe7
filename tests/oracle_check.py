"""Compare registered queries with their SQL counterparts.

``python -m tests.oracle_check [folder] [name ...]``
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    """One value in a form both engines share."""
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return Counter(tuple(plain(row[at]) for at in order) for row in rows)


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def differences(spark, connection, folder, name):
    """Text telling how a query differs from its SQL; empty when it does not."""
    frame = contract.queries()[name](spark, folder)
    mine = bag(frame.collect(), frame.columns)
    answer = connection.execute(contract.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    theirs = bag(answer.fetchall(), names)
    shared = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    types = {column[0]: str(column[1]) for column in answer.description}
    for name_, kind in frame.dtypes:
        kind = shared.get(kind, {"int": "INTEGER"}.get(kind, kind.upper()))
        if types.get(name_) != kind:
            return f"{name_} is {kind} and {types.get(name_)}"
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if mine != theirs:
        left, right = mine - theirs, theirs - mine
        return (
            f"{mine.total()} and {theirs.total()} rows, {left.total()} and {right.total()} apart, "
            f"such as {list(left)[:2]} and {list(right)[:2]}"
        )
    return "" if mine else "no rows"


def main():
    from tests.conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(contract.queries())
    spark, connection = make_session(), connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'equal'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    spark.stop()


if __name__ == "__main__":
    main()
