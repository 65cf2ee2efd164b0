"""Versioned cells: (row_key, family, qualifier, version_ts, seq, value[, op]) as one long table.

``seq`` breaks ties between versions with one timestamp. Everything is an aggregation or a filter over the long table;
no row is ever assembled from an unbounded number of cells.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.tables import exists
from weftline.plans.sizing import broadcast_if_small

CELL = ["row_key", "family", "qualifier"]
COUNTER = "row_key string, family string, qualifier string, counter long"


def newest() -> Column:
    return F.struct("version_ts", "seq")


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of every cell; versions are combined before the shuffle."""
    last = cells.groupBy(*CELL).agg(F.max_by(F.struct("value", "version_ts", "seq"), newest()).alias("v"))
    return last.select(*CELL, "v.version_ts", "v.seq", "v.value")


def versions(cells: DataFrame, count: int) -> DataFrame:
    """The newest ``count`` versions of every cell, numbered from 1; surplus versions are dropped before the shuffle."""
    newest_first = W.partitionBy(*CELL).orderBy(F.desc("version_ts"), F.desc("seq"))
    return cells.withColumn("version_no", F.row_number().over(newest_first)).filter(F.col("version_no") <= count)


def get_rows(cells: DataFrame, row_keys: list[str]) -> DataFrame:
    return latest(cells.filter(F.col("row_key").isin(row_keys)))


def get_many(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose key is listed in ``wanted(row_key)``."""
    return latest(cells.join(broadcast_if_small(wanted.select("row_key").distinct()), "row_key", "left_semi"))


def first_rows(cells: DataFrame, rows: int) -> DataFrame:
    """All cells of the first ``rows`` row keys: a limit on rows, not on cells."""
    keys = cells.select("row_key").distinct().orderBy("row_key").limit(rows)
    return latest(cells.join(F.broadcast(keys) if rows <= 100_000 else keys, "row_key", "left_semi"))


def key_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """Row keys from ``start`` (included) to ``stop`` (excluded)."""
    return cells.filter((F.col("row_key") >= start) & (F.col("row_key") < stop))


def rows_matching(
    cells: DataFrame, tests: dict[tuple[str, str], Column], mode: str = "and", filter_if_missing: bool = False
) -> DataFrame:
    """Whole rows by tests on columns, each a predicate on ``value`` of the latest cell of (family, qualifier).

    A row without the column passes its test unless ``filter_if_missing``. All tests share one aggregation.
    """
    current = latest(cells)
    flags = []
    for (family, qualifier), predicate in tests.items():
        here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        verdict = F.max(F.when(here, predicate))
        flags.append(F.coalesce(verdict, F.lit(not filter_if_missing)))
    passed = flags[0]
    for flag in flags[1:]:
        passed = (passed & flag) if mode == "and" else (passed | flag)
    keep = current.groupBy("row_key").agg(passed.alias("passed")).filter("passed").select("row_key")
    return current.join(keep, "row_key", "left_semi")


def column_page(cells: DataFrame, limit: int, offset: int) -> DataFrame:
    """Columns ``offset+1 .. offset+limit`` of every row in (family, qualifier) order."""
    in_row = W.partitionBy("row_key").orderBy("family", "qualifier")
    placed = latest(cells).withColumn("column_no", F.row_number().over(in_row))
    return placed.filter((F.col("column_no") > offset) & (F.col("column_no") <= offset + limit))


def visible(log: DataFrame) -> DataFrame:
    """Latest cells of a log with tombstones: op is put, delete_column or delete_row.

    A tombstone hides every version up to its own time; a later put shows again. Row tombstones carry no column, so
    they are reduced to one time per row and joined, while column tombstones fall out of the cell aggregation itself.
    """
    at = F.struct("version_ts", "seq")
    cells = log.filter("op <> 'delete_row'").groupBy(*CELL).agg(
        F.max_by(F.struct("value", "version_ts", "seq"), F.when(F.col("op") == "put", at)).alias("v"),
        F.max(F.when(F.col("op") == "delete_column", at)).alias("column_gone"),
    )
    rows = log.filter("op = 'delete_row'").groupBy("row_key").agg(F.max(at).alias("row_gone"))
    stamp = F.struct("v.version_ts", "v.seq")
    alive = cells.filter(
        F.col("v.version_ts").isNotNull() & (F.col("column_gone").isNull() | (stamp > F.col("column_gone")))
    ).join(rows, "row_key", "left").filter(F.col("row_gone").isNull() | (stamp > F.col("row_gone")))
    return alive.select(*CELL, "v.version_ts", "v.seq", "v.value")


def retain(cells: DataFrame, keep_versions: dict[str, int], ttl_seconds: dict[str, int], as_of: Column) -> DataFrame:
    """Compaction by family: at most n versions, nothing older than the time to live."""
    kept = F.lit(True)
    for family, ttl in ttl_seconds.items():
        old = F.col("version_ts") <= as_of - F.make_dt_interval(secs=F.lit(float(ttl)))
        kept = kept & ~((F.col("family") == family) & old)
    most = F.lit(1)
    for family, count in keep_versions.items():
        most = F.when(F.col("family") == family, count).otherwise(most)
    young = versions(cells.filter(kept), max(keep_versions.values(), default=1))
    return young.filter(F.col("version_no") <= most)


def increment(deltas: DataFrame) -> DataFrame:
    """Counter values: the sum of all increments per cell."""
    return deltas.groupBy(*CELL).agg(F.sum("delta").alias("counter"))


def to_cells(wide: DataFrame, row_key: str, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """Cells from a wide table by ``{column: (family, qualifier)}``; nulls make no cell."""
    long = wide.unpivot([row_key], list(mapping), "_column", "value").filter(F.col("value").isNotNull())
    family = F.create_map(*[F.lit(x) for c, (f, _) in mapping.items() for x in (c, f)])
    qualifier = F.create_map(*[F.lit(x) for c, (_, q) in mapping.items() for x in (c, q)])
    return long.select(
        F.col(row_key).alias("row_key"), family[F.col("_column")].alias("family"),
        qualifier[F.col("_column")].alias("qualifier"), "value",
    )


def to_wide(cells: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per row key with the latest value of each mapped column; the column list is given, never discovered."""
    columns = []
    for name, (family, qualifier) in mapping.items():
        here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        columns.append(F.max_by("value", F.when(here, newest())).alias(name))
    wanted = F.lit(False)
    for family, qualifier in mapping.values():
        wanted = wanted | ((F.col("family") == family) & (F.col("qualifier") == qualifier))
    return cells.filter(wanted).groupBy("row_key").agg(*columns)


def salted_key(key: Column, buckets: int) -> Column:
    """Bucket from the first four bytes of the key's md5, so other systems can compute the same prefix."""
    bucket = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(buckets))
    return F.concat_ws("_", bucket.cast("string"), key)


def hashed_key(key: Column) -> Column:
    return F.concat_ws("_", F.substring(F.md5(key), 1, 8), key)


def newest_first_key(prefix: Column, version_ts: Column) -> Column:
    """A suffix that sorts newest first: Long.MAX_VALUE minus the time in microseconds, zero-padded to 19 digits."""
    reverse = F.lit(2**63 - 1) - F.unix_micros(version_ts.cast("timestamp"))
    return F.concat_ws(":", prefix, F.format_string("%019d", reverse))


def region_of(key: Column, split_points: list[str]) -> Column:
    """Number of the region a key falls into: how many split points are not above it."""
    return sum((F.when(key >= point, 1).otherwise(0) for point in split_points), F.lit(0))


class Published:
    """A cell table that is loaded as a whole. A load becomes the current one by its line in a log, a single file written after
    the load has been counted and spot-checked; until then, and if it fails, readers see the load before."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, schema

    def _log(self) -> DataFrame:
        return self.spark.read.schema("load int, folder string, n_rows long").parquet(f"{self.root}/log")

    def _newest(self):
        return self._log().agg(F.max_by(F.struct("load", "folder", "n_rows"), "load").alias("m")).first().m

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._newest().folder)

    def publish(self, cells: DataFrame, spots: int = 100) -> int:
        """Globally sorted files: range partitions on the row key, sorted inside. Returns the number of the load.

        ``cells`` is read twice and should be stored. Its rows are counted against the files, and ``spots`` of them, those first
        in hash order, must be found there.
        """
        folder = f"{self.root}/loads/{uuid.uuid4().hex}"
        ordered = cells.repartitionByRange("row_key", "family", "qualifier").sortWithinPartitions(*CELL)
        ordered.write.parquet(folder)
        stored = self.spark.read.schema(self.schema).parquet(folder)
        n = cells.count()
        picked = cells.orderBy(F.xxhash64(*cells.columns)).limit(spots).distinct().collect()  # at most ``spots`` rows
        some = self.spark.createDataFrame(picked, cells.schema)
        found = [stored[c].eqNullSafe(some[c]) for c in cells.columns]
        hits = stored.join(F.broadcast(some), reduce(and_, found), "left_semi").distinct().count()
        if stored.count() != n or hits != len(picked):
            raise RuntimeError(f"the load in {folder} does not hold what was given; the one before stays current")
        known = exists(self.spark, f"{self.root}/log")
        load = self._newest().load + 1 if known else 0
        line = self.spark.range(1).select(F.lit(load).alias("load"), F.lit(folder).alias("folder"), F.lit(n).alias("n_rows"))
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return load


def publish_sorted(cells: DataFrame, path: str) -> DataFrame:
    """The first load of a new table at ``path``."""
    table = Published(cells.sparkSession, path, ", ".join(f"{n} {t}" for n, t in cells.dtypes))
    table.publish(cells)
    return table.read()


class Counters:
    """Stored counters that batches of increments are added to exactly once.

    The sums of a batch are a folder that bears its number: a batch delivered again replaces its folder. `fold` adds the batches
    up to some number into a new base and names it in a log, in one file; later copies of folded batches are ignored.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _base(self):
        if not exists(self.spark, f"{self.root}/log"):
            return None
        log = self.spark.read.schema("through long, folder string").parquet(f"{self.root}/log")
        return log.agg(F.max_by(F.struct("through", "folder"), "through").alias("m")).first().m

    def add(self, deltas: DataFrame, batch_id: int) -> None:
        base = self._base()
        if base is None or batch_id > base.through:
            increment(deltas).write.mode("overwrite").parquet(f"{self.root}/batches/batch_id={batch_id}")

    def read(self, through: int | None = None) -> DataFrame:
        base = self._base()
        parts = self.spark.read.schema(f"{COUNTER}, batch_id long").parquet(f"{self.root}/batches")
        if through is not None:
            parts = parts.filter(F.col("batch_id") <= through)
        if base is not None:
            parts = parts.filter(F.col("batch_id") > base.through).drop("batch_id").unionByName(
                self.spark.read.schema(COUNTER).parquet(base.folder))
        return increment(parts.withColumnRenamed("counter", "delta"))

    def fold(self, through: int) -> None:
        folder = f"{self.root}/bases/{uuid.uuid4().hex}"
        self.read(through).write.parquet(folder)
        line = self.spark.range(1).select(F.lit(through).cast("long").alias("through"), F.lit(folder).alias("folder"))
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
