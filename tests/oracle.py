"""Compare bound queries with their SQL in DuckDB: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def compare(spark_df, connection, sql: str) -> str | None:
    """None if both give the same columns, types of value and rows; otherwise what differs."""
    result = connection.execute(sql)
    names, expected = _rows([d[0] for d in result.description], result.fetchall())
    columns, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if columns != names:
        return f"columns {sorted(set(columns) ^ set(names))}"
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    for mine, theirs in zip(got, expected):
        if any(type(a) is not type(b) for a, b in zip(mine, theirs) if a is not None and b is not None):
            wrong = [(c, type(a), type(b)) for c, a, b in zip(columns, mine, theirs) if type(a) is not type(b)]
            return f"types differ in {wrong[:8]}"
        if mine != theirs:
            wrong = [(c, a, b) for c, a, b in zip(columns, mine, theirs) if a != b]
            return f"row differs in {wrong[:3]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    from munimetrics.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                verdict = compare(query(spark, folder), connection, sqls[name])
            else:
                verdict = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        kind = "sql" if name in sqls else "rows"
        print(f"{name:28s} {kind:4s} {time.time() - start:6.1f}s {verdict or 'ok'}", flush=True)
    print(f"{bad} bad", flush=True)


if __name__ == "__main__":
    main()
