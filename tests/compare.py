"""Run named queries next to their SQL checks and compare whole results.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when both sides have the same columns, types and exactly the same rows."""
    actual, expected = spark_df.toArrow(), connection.execute(sql).to_arrow_table()
    names = sorted(actual.column_names)
    if names != sorted(expected.column_names):
        return [f"columns {names} != {sorted(expected.column_names)}"]
    found = []
    if actual.num_rows != expected.num_rows:
        found.append(f"rows {actual.num_rows} != {expected.num_rows}")
    connection.register("actual_rows", actual.select(names))
    connection.register("expected_rows", expected.select(names))
    for left, right in (("actual_rows", "expected_rows"), ("expected_rows", "actual_rows")):
        extra = connection.execute(
            f"SELECT * FROM {left} EXCEPT ALL SELECT * FROM {right}"
        ).fetchall()
        if extra:
            found.append(f"{len(extra)} only in {left}, e.g. {min(extra, key=str)}")
    for name in names:
        kinds = {str(t.schema.field(name).type) for t in (actual, expected)}
        if len(kinds) > 1 and kinds != {"string", "large_string"}:
            found.append(f"type of {name}: {sorted(kinds)}")
    return found


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from weekcast.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    connection, queries, checks = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        frame = queries[name](spark, sf_dir)
        rows = frame.count() if name not in checks else None
        problems = differences(frame, connection, checks[name]) if name in checks else []
        bad += bool(problems)
        status = "BAD" if problems else "ok"
        seconds = time.time() - start
        print(f"{status:4}{name:32}{seconds:7.2f}s {problems or ''} {rows or ''}", flush=True)
    print(f"{bad} of {len(argv[1:] or queries)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
