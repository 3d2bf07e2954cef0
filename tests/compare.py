"""Compare registered queries with their oracles: python tests/compare.py [sf_dir] [query ...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, sf_dir, name, function, sql, connection):
    """Message on a mismatch, else None."""
    result = function(spark, sf_dir)
    got = canonical(result.columns, [tuple(r) for r in result.collect()])
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    wanted = canonical(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} <> {sorted(columns)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows <> {len(wanted)}"
    for mine, theirs in zip(got, wanted):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine!r:.600} <> {theirs!r:.600}"
    return None if got else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as contract
    from palimpsest.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    oracles = contract.oracle_sql()
    failed = 0
    for name, function in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            problem = compare(spark, sf_dir, name, function, oracles[name], connection) if name in oracles else "no oracle"
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
