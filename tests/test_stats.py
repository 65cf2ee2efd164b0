"""Mergeable column profiles: error bounds, merging, hot and null partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.adapters import table
from weftline.plans import stats
from weftline.queries.statistics import partition_sketches
from weftline.session import land


def rows_of(spark):
    """30,000 rows, eight tenths of them in one partition, 3 in a null one."""
    part = F.when(F.col("id") < 24_000, "hot").when(F.col("id") < 29_997, F.concat(F.lit("p"), F.col("id") % 7))
    word = F.when(F.col("id") % 3 == 0, "often").otherwise(F.concat(F.lit("w"), F.col("id")))
    return spark.range(30_000).select(
        part.alias("part of"), (F.col("id") * 7919 % 10_007).alias("n"), word.alias("word"),
        F.when(F.col("id") > 24_000, F.col("id") / 4).alias("late"), F.lit(None).cast("int").alias("nothing"))


def test_table_row_merged_from_partitions_is_within_its_bounds(spark):
    rows = rows_of(spark)
    parts = land(stats.sketch_partitions(rows, "part of"), "parts")
    assert parts.count() == 9
    whole = {r.column_name: r for r in stats.described(stats.merged(parts)).collect()}
    assert {c: (r.part, r.n_rows, r.nulls) for c, r in whole.items()} == {
        "n": (None, 30_000, 0), "word": (None, 30_000, 0), "late": (None, 30_000, 24_001), "nothing": (None, 30_000, 30_000)}
    assert (whole["n"].low, whole["n"].high) == ("0", "10006") and whole["late"].high == "7499.75"
    error = 3 * 1.04 / 2 ** (stats.LG_K / 2)
    for column, distinct in (("n", 10_007), ("word", 20_001), ("late", 5_999)):
        assert whole[column].distinct_estimate == pytest.approx(distinct, rel=error)
    assert whole["n"].median_estimate == pytest.approx(5003, abs=0.02 * 10_007)
    assert whole["nothing"].distinct_estimate == 0 and whole["nothing"].median_estimate is None and whole["nothing"].frequent == []
    assert whole["word"].median_estimate is None and whole["word"].frequent[0]["item"] == "often"
    assert whole["word"].frequent[0]["count"] == pytest.approx(10_000, rel=0.02)
    hot = [r for r in stats.described(parts).collect() if r.part == "hot" and r.column_name == "late"][0]
    assert (hot.n_rows, hot.nulls, hot.median_estimate) == (24_000, 24_000, None)


def test_a_new_partition_adds_its_row_to_stored_sketches(spark, tmp_path):
    rows, path = rows_of(spark).withColumnRenamed("part of", "p"), str(tmp_path / "stored")
    for take in (F.col("p") == "hot", ~F.col("p").eqNullSafe("hot")):
        stats.sketch_partitions(rows.filter(take), "p").write.mode("append").parquet(path)
    once = stats.described(stats.merged(stats.sketch_partitions(rows, "p")))
    exact = ["column_name", "n_rows", "nulls", "low", "high"]
    stored = stats.described(stats.merged(spark.read.parquet(path)))
    assert sorted(map(str, stored.select(*exact).collect())) == sorted(map(str, once.select(*exact).collect()))


def test_sketches_shuffle_one_row_per_task_and_partition(spark):
    plan = stats.sketch_partitions(rows_of(spark), "part of")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_empty_table(spark):
    empty = stats.sketch_partitions(rows_of(spark).limit(0), "part of")
    assert empty.count() == 0
    assert stats.merged(empty).count() == 0


def test_registered_estimates(spark, sf):
    found = {(r.part, r.column_name): r for r in partition_sketches(spark, sf).collect()}
    customers = table(spark, sf, "customer")
    assert len(found) == 4 * (1 + customers.select("c_nationkey").distinct().count())
    assert found[None, "c_custkey"].distinct_estimate == pytest.approx(customers.count(), rel=0.04)
    true = customers.agg(F.percentile("c_acctbal", 0.45).alias("lo"), F.percentile("c_acctbal", 0.55).alias("hi")).first()
    assert true.lo <= found[None, "c_acctbal"].median_estimate <= true.hi
    segments = dict(customers.groupBy("c_mktsegment").count().collect())
    name, n = found[None, "c_mktsegment"].frequent.split(",")[0].split(":")
    assert segments[name] == int(n) == max(segments.values())
