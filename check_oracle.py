"""Run the registered queries on Spark and their SQL on DuckDB and compare the rows.

    python check_oracle.py [--sf DIR] [--cores N] [query ...]
"""

from __future__ import annotations

import argparse
import time
from collections import Counter

import duckdb

from webloom.plans import QUERIES
from webloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def as_rows(columns: list[str], rows) -> Counter:
    """Rows as a multiset, columns in name order, numbers in one notation."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return f"{value + 0.0:.9g}"
        return str(value)

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool | None, str]:
    """Whether the query matches its SQL (None: it has none), and a short report."""
    started = time.time()
    frame = QUERIES[name].build(spark, sf_dir)
    collected = frame.collect()
    took = time.time() - started
    if QUERIES[name].sql is None:
        return None, f"{len(collected)} rows, {took:.1f}s, no SQL"
    started = time.time()
    result = connection.execute(QUERIES[name].sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} / {sorted(columns)}"
    theirs = as_rows(columns, result.fetchall())
    ours = as_rows(frame.columns, collected)
    report = f"{len(collected)} rows, {took:.1f}s / {time.time() - started:.1f}s"
    if ours == theirs:
        return True, report
    missing, extra = list((theirs - ours).elements()), list((ours - theirs).elements())
    return False, (
        f"{report}; {len(missing)} missing, {len(extra)} extra\n    missing {missing[:3]}"
        f"\n    extra   {extra[:3]}"
    )


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--cores", default="8")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = local_session(options.cores)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_tables(options.sf)
    wrong = 0
    for name in options.names or QUERIES:
        try:
            ok, report = compare(spark, connection, name, options.sf)
        except Exception as error:  # a failing query must not hide the others
            ok, report = False, f"{type(error).__name__}: {str(error)[:600]}"
        wrong += ok is False
        print(f"{ {True: 'ok  ', False: 'BAD ', None: '----'}[ok] } {name}: {report}", flush=True)
    print(f"{wrong} wrong")


if __name__ == "__main__":
    main()
