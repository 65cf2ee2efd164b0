"""Dimensions and history: slowly changing dimensions, change feeds, surrogate keys, checks on data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ordered import framed, needs_slices
from weftline.operators.versions import VersionedTable
from weftline.plans.sizing import GROUP_ROWS
from weftline.session import land


def surrogate_key(*parts: Column) -> Column:
    """A stable 128-bit key from the business key, computed row by row: no counter, no shuffle.

    Every part carries its length, and a null part has none, so different parts never make the same text.
    """
    marked = [F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("null"))
              for p in parts]
    return F.md5(F.concat_ws("|", *marked))


def history(
    changes: DataFrame, key: str, value: str, at: str, tie: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Type-2 history: one row per stretch of an unchanged value, [valid_from, valid_to), the last one current."""
    order = [(at, False), (tie, False)]
    sizing = {"sliced": needs_slices(changes, [key], group_rows)}
    seen = framed(changes, [key], order, lambda w: {"_before": F.lag(F.struct(value)).over(w)}, 1, 0, **sizing)
    starts = seen.filter(~F.col("_before").eqNullSafe(F.struct(value)) | F.col("_before").isNull()).drop("_before")
    ended = framed(starts, [key], order, lambda w: {"valid_to": F.lead(at).over(w)}, 0, 1, **sizing)
    return ended.select(
        key, value, F.col(at).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def observed(
    changes: DataFrame, key: str, value: str, at: str, tie: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Every observation of a key, in what a stored type-2 dimension needs: whether it ``starts`` a stretch, and if so where the
    stretch ends (``valid_to``, null while it lasts). Observations that repeat the value before them are kept: a late change
    between them may make them the start of a stretch."""
    order = [(at, False), (tie, False)]
    sizing = {"sliced": needs_slices(changes, [key], group_rows)}
    rows = changes.select(key, value, at, tie)
    seen = framed(rows, [key], order, lambda w: {"_before": F.lag(F.struct(value)).over(w)}, 1, 0, **sizing)
    new = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.struct(value))
    seen = seen.withColumn("starts", new).drop("_before")
    if sizing["sliced"]:
        seen = land(seen, "observed")  # a plain window is one shuffle, which both uses below share
    ended = framed(seen.filter("starts"), [key], order, lambda w: {"valid_to": F.lead(at).over(w)}, 0, 1, **sizing)
    return ended.unionByName(seen.filter("not starts").withColumn("valid_to", F.lit(None).cast(dict(rows.dtypes)[at])))


def stretches(stored: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """The type-2 view of stored observations: one row per stretch, [valid_from, valid_to), the last one current."""
    return stored.filter("starts").select(
        key, value, F.col(at).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def merge_history(
    stored: VersionedTable, delivery: DataFrame, key: str, value: str, at: str, tie: str, group_rows: int = GROUP_ROWS
) -> int:
    """Merge a delivery of changes into a stored dimension, whatever times they have; returns the new version.

    Only keys of the delivery are worked on and only their buckets rewritten. A late change splits the stretch it falls into. An
    observation delivered again (same key, time and tie) replaces the earlier one, so a repeated delivery changes nothing.
    ``stored`` has the columns of `observed` and ``key`` as its key. Null keys are left out.
    """
    fresh = delivery.filter(F.col(key).isNotNull()).groupBy(key, at, tie).agg(F.max(value).alias(value))
    before = stored.read().select(key, value, at, tie).join(fresh.select(key).distinct(), key, "left_semi")
    again = before[at].eqNullSafe(fresh[at]) & before[tie].eqNullSafe(fresh[tie]) & (before[key] == fresh[key])
    kept = before.join(fresh, again, "left_anti")
    every = land(kept.unionByName(fresh.select(key, value, at, tie)), "every")
    return stored.upsert(land(observed(every, key, value, at, tie, group_rows), "merged"))


def apply_changes(feed: DataFrame, key: str, sequence: str, columns: list[str]) -> DataFrame:
    """State after a change feed ``op`` in c, u, d: the latest change of every key, deleted keys gone."""
    last = feed.groupBy(key).agg(F.max_by(F.struct("op", *columns), sequence).alias("last"))
    return last.filter("last.op <> 'd'").select(key, *[F.col(f"last.{c}").alias(c) for c in columns])


def quality_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Failed rows of every check in one pass; a check is true where a row is fine, null counts as failed."""
    failed = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()],
    )
    return failed.unpivot(["n_rows"], list(checks), "check_name", "failed")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows in all, and how many of them repeat a key already seen."""
    counts = df.groupBy(key).agg(F.count("*").alias("c"))
    return counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("failed")
    )


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows in all, and how many have a key without parent; rows are counted per key before the join."""
    keys = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("c"))
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    checked = keys.join(known, F.col("_k") == F.col("_p"), "left")
    lost = F.when(F.col("_p").isNull(), F.col("c")).otherwise(0)
    return checked.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(lost), F.lit(0)).alias("failed")
    )
