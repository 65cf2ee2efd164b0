"""Helpers the operators share: words, hash slices, running totals over slices, bounded training samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.session import land

#: Fixed value: what counts as a word everywhere in this package (the white space of ASCII separates words).
WORD = r"[^\x20\x09-\x0D]+"
#: Rows one task should number or sum in one go.
SLICE_ROWS = 200_000
#: Labelled rows a model is fitted on, at most.
SAMPLE_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_key(*columns: Column) -> Column:
    """A repeatable pseudo-random long from 0 to 2^62 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def key_slice(key: Column, slices: Column) -> Column:
    """Which of ``slices`` equal ranges of the key's domain holds the key: a pure function, so a rerun agrees."""
    return F.least(F.floor(key / F.lit(float(1 << 62)) * slices), slices - 1).cast("long")


def slices_for(rows: Column, per_slice: int = SLICE_ROWS) -> Column:
    return F.greatest(F.ceil(rows / per_slice), F.lit(1)).cast("long")


def number(rows: DataFrame, group: str, key: str, ties: list[str], value: str | None, position: str,
           before: str | None = None, per_slice: int = SLICE_ROWS) -> DataFrame:
    """Number the rows of every group in key order (from 0) and sum ``value`` over the rows before each.

    ``key`` must come from `unit_key`. A group of any size is cut into key ranges: each range is counted and summed first,
    the totals of the ranges before are added to a window inside the range. No group meets in one task.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_rows")).select(F.col(group).alias("_group"), "_rows")
    sliced = rows.join(sizes, F.col(group).eqNullSafe(F.col("_group"))).withColumn(
        "_slice", key_slice(F.col(key), slices_for(F.col("_rows"), per_slice))
    ).drop("_group", "_rows")
    sliced = land(sliced, "slices")
    amount = F.col(value) if value else F.lit(0)
    parts = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_n"), F.sum(amount).alias("_v"))
    earlier = W.partitionBy(group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(
        F.col(group).alias("_group"), F.col("_slice").alias("_part"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_v0"),
    )
    inside = W.partitionBy(group, "_slice").orderBy(key, *ties)
    numbered = sliced.withColumn("_at", F.row_number().over(inside))
    if value:
        numbered = numbered.withColumn(
            "_sum", F.coalesce(F.sum(value).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        )
    joined = numbered.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_part")))
    out = joined.withColumn(position, F.col("_at") - 1 + F.col("_n0"))
    if value and before:
        out = out.withColumn(before, F.col("_sum") + F.col("_v0"))
    return out.drop("_slice", "_group", "_part", "_n0", "_v0", "_at", "_sum")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0))


def labelled_sample(labels: DataFrame, label: str, keep: Column | None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids, the same ones on every run: those first in hash order.

    An id labelled more than once keeps its largest label; null ids and null labels are left out.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if keep is not None:
        usable = usable.filter(keep)
    single = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    return single.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The documents of a bounded sample (so it may be broadcast) with their ``_label``."""
    return docs.join(F.broadcast(sample), "doc_id")


def ceil_div(a: int, b: int) -> int:
    return math.ceil(a / b)
