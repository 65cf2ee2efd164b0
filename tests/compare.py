"""Run registered queries next to their SQL in DuckDB and compare names, types, row counts and values.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def spark_rows(frame):
    order = sorted(range(len(frame.columns)), key=lambda i: frame.columns[i])
    types = [TYPE_NAMES.get(frame.dtypes[i][1], frame.dtypes[i][1].upper()) for i in order]
    rows = [tuple(plain(r[i]) for i in order) for r in frame.collect()]
    return [frame.columns[i] for i in order], types, sorted(rows, key=sort_key)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in cursor.fetchall()]
    return [names[i] for i in order], [types[i] for i in order], sorted(rows, key=sort_key)


def difference(frame, con, sql) -> tuple[str | None, int]:
    names, types, got = spark_rows(frame)
    want_names, want_types, want = duck_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}", len(got)
    if types != want_types:
        return f"types {list(zip(names, types, want_types))}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    for a, b in zip(got, want):
        if a != b:
            return f"values {a} != {b}", len(got)
    return None, len(got)


def main() -> int:
    from weftline import registry

    args = sys.argv[1:]
    scale = "0.01"
    if args[:1] == ["--sf"]:
        scale, args = args[1], args[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = registry.all_queries(), registry.all_oracles()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in oracles:
                problem, rows = difference(frame, con, oracles[name])
            else:
                problem, rows = None, frame.count()
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", 0
        failed += problem is not None
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{name:32}{rows:>8} rows {time.time() - start:6.2f}s  {problem or ''}", flush=True)
    print("failed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
