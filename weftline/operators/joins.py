"""Joins beyond the built-in ones: explicit hot-key salting, bounded cartesian product, literal lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.sizing import hot_keys, settle

HOT_KEY_ROWS = 100_000
HOT_KEYS_AT_MOST = 10_000


def bucketed_join(big: DataFrame, other: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """Inner join of two tables bucketed on ``key``: no row is shuffled.

    A bucket is one task, so rows of hot keys (see ``salted_join``) are joined apart: there are at most 10,000 such keys
    and their rows of the other table are counted and broadcast, which leaves the hot rows spread over the scan's tasks.
    """
    total = big.count()
    if hot_rows is None:
        hot_rows = max(HOT_KEY_ROWS, total // HOT_KEYS_AT_MOST)
    if total <= hot_rows:
        return big.join(other.hint("merge"), key)
    hot = settle(hot_keys(big, key, hot_rows, total))
    cold = big.join(hot, key, "left_anti").join(other.hint("merge"), key)
    apart = big.join(hot, key, "left_semi").join(settle(other.join(hot, key, "left_semi")), key)
    return cold.unionByName(apart)


def salted_join(
    big: DataFrame, small: DataFrame, key: str, row_id: str, salts: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Inner join where the rows of hot keys are spread over several tasks.

    A key is hot when it alone has more rows than a task's even share of ``big``, so there are fewer hot keys than shuffle
    partitions, and their list is a small literal table. A hot key gets one salt for each share it holds (or ``salts``);
    only its rows on the other side are repeated, as often as it has salts. Without a hot key this is the plain join.
    """
    spark = big.sparkSession
    total = big.count()
    share = hot_rows if hot_rows is not None else max(1, total // int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(big.filter(F.col(key).isNotNull()), key, share, total, counted=True).collect() if total > share else []
    if not hot:
        return big.join(small, key)
    listed = spark.createDataFrame(
        [(k, salts or -(-n // share)) for k, n in hot], f"_hot {dict(big.dtypes)[key]}, _salts int")
    of_key = F.col(key) == F.col("_hot")
    repeats = F.coalesce(F.col("_salts"), F.lit(1))
    left = big.join(F.broadcast(listed), of_key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(row_id), repeats).cast("int")).drop("_hot", "_salts")
    right = small.join(F.broadcast(listed), of_key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), repeats - 1))).drop("_hot", "_salts")
    return left.join(right, [key, "_salt"]).drop("_salt")


def product_with_list(df: DataFrame, name: str, values: list[str], limit: int = 1_000) -> DataFrame:
    """Every row paired with every entry of a short literal list; the fan-out is bounded by the list length."""
    if len(values) > limit:
        raise ValueError(f"the list has {len(values)} entries, the bound is {limit}")
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
