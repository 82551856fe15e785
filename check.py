"""Compare registered queries with their SQL: python check.py [folder] [name part ...]."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

import duckdb

from tierworks.plans.catalog import REGISTRY
from tierworks.schemas import TABLES
from tierworks.session import build_session


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, int):
        return value
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(keyed, key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


KINDS = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, folder: str, query) -> str | None:
    """None when equal, otherwise the first difference."""
    df = query.build(spark, folder)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if query.sql is None:
        return None if got[1] or df.columns else "no columns"
    cursor = con.execute(query.sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    want = sorted_rows(names, cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0]}"
    wrong = {n: (t, kinds[n]) for n, t in df.dtypes if KINDS.get(t, t) != kinds[n]}
    return f"types {wrong}" if wrong else None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, query in sorted(REGISTRY.items()):
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, query)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if query.sql else '(rows only)'} {problem or ''}", flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main()
