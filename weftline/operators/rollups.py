"""Mergeable summaries: partial totals and distinct-count sketches that are combined instead of recomputed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partial_totals(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )


def merge_totals(partials: DataFrame, keys: list[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def rollup_totals(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Subtotals along the key hierarchy; ``level`` is how many keys are rolled up."""
    return merged.rollup(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.bit_count(F.grouping_id()).cast("int").alias("level"),
    )


def distinct_sketches(df: DataFrame, keys: list[str], value: str, precision: int = 14) -> DataFrame:
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
