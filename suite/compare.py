"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return f"{value:.6f}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, connection, query, statement: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    ours = canonical(frame.columns, frame.collect())
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    theirs = canonical(names, cursor.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{left} against {right}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from stratamart.session import local_session
    from suite.oracle import ORACLE
    from suite.queries import QUERIES

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session("compare", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            if name in ORACLE:
                result = difference(spark, connection, query, ORACLE[name], sf_dir)
            else:
                result = f"no SQL, {query(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"{name:28s} {time.time() - started:6.1f}s  {result or 'same'}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(QUERIES) - set(ORACLE))}; SQL only: {sorted(set(ORACLE) - set(QUERIES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
