"""Run named queries and their SQL side by side: `python tests/compare.py [sf_dir] [name ...]`."""

from __future__ import annotations

import glob
import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def cell(value) -> str:
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    return str(value)


def digest(columns: list[str], rows) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(cell(r[i]) for i in order) for r in rows)
    return sorted(columns), len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, run, sql: str, sf_dir: str):
    start = time.time()
    frame = run(spark, sf_dir)
    ours = (*digest(frame.columns, frame.collect()), sorted((n, SAME_TYPE.get(t, t)) for n, t in frame.dtypes))
    took = time.time() - start
    start = time.time()
    cursor = con.execute(sql)
    types = sorted((d[0], str(d[1])) for d in cursor.description)
    theirs = (*digest([d[0] for d in cursor.description], cursor.fetchall()), types)
    return ours, theirs, took, time.time() - start


def main() -> None:
    from tests.session import session

    from freshet.catalog import all_queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            if query.sql:
                ours, theirs, took, sql_took = compare(spark, con, query.run, query.sql, sf_dir)
                ok = ours == theirs
                print(f"{'ok ' if ok else 'BAD'} {name:28} rows {ours[1]:7} {took:6.1f}s sql {sql_took:5.1f}s")
                if not ok:
                    bad += 1
                    print("   ", ours, theirs)
            else:
                start = time.time()
                print(f"--  {name:28} rows {query.run(spark, sf_dir).count():7} {time.time() - start:6.1f}s")
        except Exception as problem:
            bad += 1
            print(f"ERR {name}: {str(problem)[:1500]}")
        sys.stdout.flush()
    print("bad:", bad)


if __name__ == "__main__":
    main()
