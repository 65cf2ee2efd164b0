"""Aggregations that stay balanced under hot keys, and bags cut into bounded chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ordered import Order, running

CHUNK_ROWS = 10_000


def salted_sum(df: DataFrame, keys: list[str], row_id: str, value: str, salts: int = 32) -> DataFrame:
    """Sum, count, min and max per key in two stages: first per (key, salt), then per key."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)))
    partial = salted.groupBy(*keys, "_salt").agg(
        F.sum(value).alias("_s"), F.count("*").alias("_c"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    return partial.groupBy(*keys).agg(
        F.sum("_s").alias("total"), F.sum("_c").alias("n_rows"), F.min("_lo").alias("low"), F.max("_hi").alias("high")
    )


def bags(
    df: DataFrame, keys: list[str], order: Order, item: Column, chunk: int = CHUNK_ROWS, **sizing
) -> DataFrame:
    """The bag of every group as ordered arrays of at most ``chunk`` items, numbered ``part`` = 0, 1, ...

    A group within the bound is one row. A hot group becomes many rows, so no array and no task holds all of it.
    """
    placed = running(df.withColumn("_item", item), keys, order, position="_pos", **sizing)
    cut = placed.withColumn("part", F.floor((F.col("_pos") - 1) / chunk).cast("long"))
    return cut.groupBy(*keys, "part").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_item"))), lambda s: s["_item"]).alias("bag")
    )
