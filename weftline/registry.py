"""Registered queries: a name, a Spark job over the test tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from weftline.session import tune

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (
    "scans",
    "layout",
    "scalar",
    "grouping",
    "joining",
    "texts",
    "windowing",
    "selection",
    "userfuncs",
    "mutation",
    "wide_cells",
    "relational_io",
    "ingestion",
    "policies",
    "statistics",
    "syllabus",
)

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir.rstrip("/"))

        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql.strip()
        return fn

    return register


def load() -> None:
    for module in MODULES:
        import_module(f"weftline.queries.{module}")


def all_queries() -> dict[str, Query]:
    load()
    return dict(_queries)


def all_oracles() -> dict[str, str]:
    load()
    return dict(_oracles)
