"""Compare registered queries with their SQL in DuckDB.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


TIMES: dict[str, float] = {}

# DuckDB's name for each Spark type the queries return.
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return f"{type(value).__name__} {value}"
    return f"{type(value).__name__} {value}"


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, fn, oracle: str, sf_dir: str) -> list[str]:
    frame = fn(spark, sf_dir)
    began = time.time()
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    TIMES["collect"] = time.time() - began
    began = time.time()
    result = connection.execute(oracle)
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    TIMES["sql"] = time.time() - began
    problems = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    kinds = {d[0]: str(d[1]) for d in result.description}
    for name, kind in frame.dtypes:
        if SQL_TYPES.get(kind) != kinds[name]:
            problems.append(f"{name} is {kind}, in SQL {kinds[name]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        problems.append(f"{len(only_got)} differ: {only_got[:2]} <> {only_want[:2]}")
    return [str(p)[:1500] for p in problems]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from brightwater import plans
    from brightwater.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", **{"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    queries, oracles = plans.all_queries(), plans.all_oracles()
    failed = 0
    for name, fn in queries.items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            if name in oracles:
                problems = differences(spark, connection, fn, oracles[name], sf_dir)
                verdict = "ok" if not problems else f"DIFF {problems}"
                verdict += f" (collect {TIMES.get('collect', 0):.1f}s, sql {TIMES.get('sql', 0):.1f}s)"
            else:
                rows = fn(spark, sf_dir).collect()
                verdict, problems = f"rows {len(rows)} e.g. {str(rows[:1])[:300]}", []
        except Exception as error:  # noqa: BLE001
            problems, verdict = [error], f"ERROR {str(error)[:900]}"
        failed += bool(problems)
        print(f"{name} {time.time() - began:.1f}s {verdict}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
