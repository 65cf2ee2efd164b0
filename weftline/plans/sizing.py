"""Size checks that decide between plans: broadcast or shuffle, one window per group or sliced groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import cut

BROADCAST_ROWS = 200_000
GROUP_ROWS = 4_000_000
SAMPLE_ROWS = 50_000_000


def row_bound(df: DataFrame, limit: int) -> int:
    """Row count, but never counting further than ``limit + 1``."""
    return df.limit(limit + 1).count()


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast only when the side was counted and is within ``limit`` rows; else leave it to the shuffle."""
    return F.broadcast(df) if row_bound(df, limit) <= limit else df


def settle(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Compute an aggregate once (reliable checkpoint), then mark it for broadcast if its counted size allows."""
    return broadcast_if_small(cut(df), limit)


def key_sample(df: DataFrame, keys: list[str], total: int) -> tuple[DataFrame, float]:
    """The key columns, thinned to about ``SAMPLE_ROWS`` rows. Only for choosing a plan, never for results."""
    fraction = min(1.0, SAMPLE_ROWS / max(total, 1))
    only_keys = df.select(*keys)
    return (only_keys if fraction == 1.0 else only_keys.sample(fraction, seed=1)), fraction


def largest_group(df: DataFrame, keys: list[str], enough: int) -> int:
    """Rows of the largest group, or any number up to ``enough`` when no group can be larger than that.

    A table within the bound is only counted. A large one is counted by key on a sample, with partial counts before the
    shuffle, so a hot key costs nothing extra.
    """
    total = df.count()
    if total <= enough or not keys:
        return total
    sample, fraction = key_sample(df, keys, total)
    counts = sample.groupBy(*keys).agg(F.count("*").alias("n"))
    return int((counts.agg(F.max("n")).first()[0] or 0) / fraction)


def hot_keys(df: DataFrame, key: str, threshold: int, total: int, counted: bool = False) -> DataFrame:
    """Keys with more than about ``threshold`` rows, with that number (``n``) if ``counted``; there can be at most about
    total/threshold of them."""
    sample, fraction = key_sample(df, [key], total)
    found = sample.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > threshold * fraction)
    return found.select(key, (F.col("n") / fraction).cast("long").alias("n")) if counted else found.select(key)


def spread(df: DataFrame) -> DataFrame:
    """Give work that costs much CPU per row enough tasks when the scan has fewer splits than there are cores.

    Large inputs have more splits than cores and pass through without a shuffle. Only for plans that are a plain scan:
    asking for the number of splits must not start a job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
