"""Run registered queries next to their SQL in DuckDB and compare all rows.

    python -m tests.oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is not None, str(v)) for v in row))


def compare(spark, con, run, sql: str, sf_dir: str) -> tuple[str | None, int]:
    """(first difference or None, rows)."""
    df = run(spark, sf_dir)
    got, names = df.collect(), df.columns
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}", len(got)
    types = {d[0]: str(d[1]) for d in result.description}
    a, b = canonical([tuple(r) for r in got], names), canonical(want, want_names)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(a)
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sorted(names)}\n   spark {x}\n   duck  {y}\n   {types}", len(a)
    return None, len(a)


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from gridloom.session import get_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(args.sf), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if args.names and name not in args.names:
            continue
        started = time.time()
        try:
            if name in oracles:
                difference, rows = compare(spark, con, run, oracles[name], args.sf)
            else:
                difference, rows = None, run(spark, args.sf).count()
        except Exception as error:  # report and go on with the next query
            difference, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += difference is not None
        verdict = "ok  " if difference is None else "FAIL"
        print(f"{verdict} {name:32s} {rows:8d} rows {time.time() - started:6.2f}s", flush=True)
        if difference:
            print("   ", difference, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
