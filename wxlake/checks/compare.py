"""Compare registered queries with their SQL twins: ``python -m wxlake.checks.compare``."""

from __future__ import annotations

import argparse
import datetime as dt
import math
import time
from collections import Counter
from pathlib import Path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(f"{sf}/{name}.parquet")
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else str(path)
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)  # no negative zero
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# DuckDB type -> Spark type.
TYPES = {
    "VARCHAR": "string", "DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def differences(spark, con, build, text: str, sf: str) -> str | None:
    """None when names and values agree, else the first difference."""
    df = build(spark, sf)
    found = con.execute(text)
    names = [c[0] for c in found.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in found.description}
    if kinds != dict(df.dtypes):
        wrong = {n: (k, kinds[n]) for n, k in df.dtypes if kinds[n] != k}
        return f"types {wrong}"
    got, want = _rows(df.columns, df.collect()), _rows(names, found.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; only Spark {sum(extra.values())}: "
        f"{list(extra)[:3]}; only SQL {sum(missing.values())}: {list(missing)[:3]}"
    )


def main() -> None:
    from wxlake.checks.queries import ORACLES, QUERIES
    from wxlake.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.001")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", extra={
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(args.sf), 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = differences(spark, con, QUERIES[name], ORACLES[name], args.sf)
            else:
                problem = None if QUERIES[name](spark, args.sf).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
