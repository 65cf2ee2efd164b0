"""Sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sample_bucket(df: DataFrame, column: str, bucket: int, buckets: int) -> DataFrame:
    """Bucket ``bucket`` (from 1) of ``buckets``: integers hash to themselves, other types by value hash."""
    integral = dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint")
    hashed = F.col(column) if integral else F.hash(column)
    return df.filter(F.pmod(hashed, F.lit(buckets)) == bucket - 1)


def sample_bytes(df: DataFrame, key: str, columns: list[str], limit: int) -> DataFrame:
    """Rows in key order until their text length passes ``limit`` bytes.

    The key must be one of the columns and not null: then every row has a byte at least, so no more than ``limit`` rows
    can be in the sample, and only the first rows in key order are sorted and summed.
    """
    if key not in columns:
        raise ValueError("the key must be one of the columns")
    size = sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns), F.lit(0))
    first = df.filter(F.col(key).isNotNull()).orderBy(key).limit(limit)
    upto = F.sum(size.cast("long")).over(W.partitionBy(F.lit(0)).orderBy(key).rowsBetween(W.unboundedPreceding, 0))
    return first.withColumn("_upto", upto).filter(F.col("_upto") <= limit).drop("_upto")


def route(df: DataFrame, branches: dict[str, Column], otherwise: str | None = None) -> DataFrame:
    """Rows labelled with every branch whose predicate holds (a row may take several, or none).

    ``otherwise`` takes rows whose predicates are all false. A null predicate is neither true nor false, so such rows
    take no branch.
    """
    labels = [F.when(p, F.lit(name)) for name, p in branches.items()]
    if otherwise:
        none = F.lit(True)
        for predicate in branches.values():
            none = none & ~predicate
        labels.append(F.when(none, F.lit(otherwise)))
    return df.withColumn("branch", F.explode(F.array_compact(F.array(*labels))))
