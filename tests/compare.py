"""Run registered queries against DuckDB on the same parquet files.

    python tests/compare.py [sf_dir] [name …]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def run_sql(con, sql: str):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return columns, types, cursor.fetchall()


def compare(spark, con, sf_dir: str, name: str, build, sql: str | None):
    """(ok, message) for one query."""
    started = time.time()
    df = build(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{len(rows)} rows, no oracle, {took:.1f}s"
    columns, types, expected = run_sql(con, sql)
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = normal_rows(df.columns, rows), normal_rows(columns, expected)
    if len(got) != len(want):
        return False, f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, first: {bad[0]}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return True, f"{len(got)} rows, {took:.1f}s  " + " ".join(
        f"{c}:{kinds[c]}/{types[c]}" for c in sorted(columns) if not same_type(kinds[c], types[c])
    )


_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
}


def same_type(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("array<"):
        return duck_type.endswith("[]") and same_type(spark_type[6:-1], duck_type[:-2])
    return _TYPES.get(spark_type, spark_type.upper()) == duck_type


def main() -> int:
    import __spark_entry__ as entry_module
    from strandline.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    names = args or list(queries)
    spark = build_session(
        "compare",
        "local[8]",
        spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="compare-"),
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        try:
            ok, message = compare(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            ok, message = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, message, flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
