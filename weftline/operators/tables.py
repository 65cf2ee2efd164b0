"""Table layout: partitioned and bucketed writes, catalog databases, small-file merging, incremental partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.session import land, scratch
from weftline.sources.files import inventory

TARGET_FILE_BYTES = 128 * 1024 * 1024
BUCKET_BYTES = 1024 * 1024 * 1024
PARTITION_FLOOR_BYTES = 128 * 1024 * 1024


def fresh_database(spark: SparkSession, comment: str = "") -> str:
    """A new database whose managed tables live in the shared scratch folder."""
    name = f"weft_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} COMMENT '{comment}' LOCATION '{scratch(spark, 'db')}'")
    return name


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of a partition value together before a partitioned write.

    A rebalance, not a repartition: adaptive execution splits a value that is too big for one task and merges small
    ones, so a hot partition becomes several files rather than one slow task.
    """
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, path: str, columns: list[str], mode: str = "overwrite", only_touched: bool = False
) -> None:
    """Write by partition. Overwriting replaces the whole folder, or with ``only_touched`` the partitions in ``df``."""
    writer = by_partition(df, *columns).write.mode(mode).partitionBy(*columns)
    writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static").parquet(path)


def bucket_count(bytes_total: int, least: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about a gigabyte, never fewer than ``least``."""
    return max(least, -(-bytes_total // bucket_bytes))


def write_bucketed(df: DataFrame, name: str, buckets: int, key: str, partitions: list[str] | None = None) -> None:
    """Bucketed table: one file per bucket, more only where one bucket is too much for a task.

    The rebalance uses as many partitions as there are buckets and the same hash, so a partition is a bucket; adaptive
    execution splits the bucket of a hot key over several tasks.
    """
    writer = df.hint("rebalance", buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def write_hours(df: DataFrame, root: str, column: str) -> None:
    """Write one directory per hour, then the ready marks: an hour is visible to readers only once marked.

    An hour that is written again replaces itself, so a repeated run changes nothing.
    """
    write_partitioned(df, f"{root}/data", [column], only_touched=True)
    df.select(column).distinct().coalesce(1).write.mode("append").parquet(f"{root}/ready")


def fill_ready_hours(
    spark: SparkSession, root: str, out: str, column: str, schema: StructType, job: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run ``job`` over the hours that are marked ready and not done yet, replacing their output partitions.

    Marks follow the data, so a lost run is repeated and overwrites its own partitions: nothing is counted twice.
    """
    ready = spark.read.parquet(f"{root}/ready").distinct()
    if exists(spark, f"{out}/ready"):
        ready = ready.join(spark.read.parquet(f"{out}/ready"), column, "left_anti")
    ready = land(ready, "ready")
    # the comparison makes the side a selective one, so the hours' folders are pruned at run time
    pending = F.broadcast(ready.filter(F.col(column) > ""))
    hours = spark.read.schema(schema).parquet(f"{root}/data")
    result = job(hours.join(pending, column, "left_semi"))
    if not ready.isEmpty():
        write_partitioned(result, f"{out}/data", [column], only_touched=True)
        ready.coalesce(1).write.mode("append").parquet(f"{out}/ready")
    return spark.read.schema(result.schema).parquet(f"{out}/data")


def total_bytes(spark: SparkSession, path: str) -> int:
    return inventory(spark, path).agg(F.sum("bytes")).first()[0] or 0


def merge_small_files(
    spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES
) -> int:
    """Rewrite a parquet folder into ceil(bytes / file_bytes) files and return that number.

    Coalescing joins neighbouring input splits without a shuffle.
    """
    files = max(1, -(-total_bytes(spark, source) // file_bytes))
    spark.read.parquet(source).coalesce(files).write.mode("overwrite").parquet(target)
    return files


def partition_advice(df: DataFrame, columns: list[str], bytes_total: int) -> DataFrame:
    """Rate candidate partition columns by distinct values and bytes per partition, in one pass."""
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "distinct_values")
    share = (F.lit(bytes_total) / F.greatest("distinct_values", F.lit(1))).cast("long")
    rating = (
        F.when(F.col("distinct_values") <= 1, "no pruning")
        .when(F.col("bytes_per_partition") >= PARTITION_FLOOR_BYTES, "good")
        .otherwise("partitions too small")
    )
    return long.withColumn("bytes_per_partition", share).withColumn("rating", rating)
