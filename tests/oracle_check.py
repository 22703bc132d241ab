"""Compare every registered query with its SQL text on the same Parquet tables.

    python -m tests.oracle_check [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value if not math.isnan(value) else "nan"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return _plain(value.asDict())
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql) -> tuple[str | None, int]:
    """(problem or None, Spark rows)."""
    spark_rows = df.collect()
    reply = con.execute(sql)
    names = [d[0] for d in reply.description]
    types = [str(d[1]) for d in reply.description]
    other = reply.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(spark_rows)
    float_sql = {n for n, t in zip(names, types) if t.split("(")[0].upper() in ("DOUBLE", "FLOAT", "DECIMAL", "NUMBER")}
    a, b = _rows(df.columns, spark_rows), _rows(names, other)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(a)
    for left, right in zip(a, b):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{sorted(names)}: {left} != {right} {sorted(float_sql)}", len(a)
    return None, len(a)


def main() -> None:
    import __spark_entry__ as entry
    from ledgerline.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--from", dest="start", default=None)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    assert Path(folder).is_dir(), folder
    spark = build_session(master="local[8]", shuffle_partitions=8, spark__ui__enabled="false",
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = args.names or list(queries)
    if args.start:
        names = names[names.index(args.start):]
    bad = []
    for name in names:
        started = time.perf_counter()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem, n = compare(df, con, oracles[name])
            else:
                problem, n = None, len(df.collect())
                if not n:
                    problem = "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        seconds = time.perf_counter() - started
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'BAD '} {kind} {name:28s} {n:7d} rows {seconds:6.2f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(names) - len(bad)}/{len(names)} ok; bad: {bad}")


if __name__ == "__main__":
    main()
