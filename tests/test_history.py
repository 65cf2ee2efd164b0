"""History, change feeds, summaries, sketches, features, and the sliced forms of jobs built on windows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.compare import duck, duck_rows, sort_key, spark_rows
from weftline import registry
from weftline.adapters import table
from weftline.operators.cells import key_range, publish_sorted
from weftline.operators.rollups import distinct_sketches, merge_sketches, merge_totals, partial_totals
from weftline.operators.tables import fresh_database, write_partitioned
from weftline.operators.versions import VersionedTable, compact, merge_deltas
from weftline.operators.warehouse import apply_changes, history, merge_history, observed, orphans, quality_report, stretches
from weftline.queries import syllabus
from weftline.queries.wide_cells import staff_cells
from weftline.session import scratch


@pytest.mark.parametrize("group_rows", [0, 100])
def test_history_collapses_repeats(spark, group_rows):
    rows = spark.createDataFrame(
        [("a", "x", 1, 1), ("a", "x", 2, 2), ("a", "y", 3, 3), ("a", "x", 4, 4), ("b", None, 1, 5), ("b", None, 2, 6)],
        "k string, v string, t int, id int")
    got = sorted((r.k, r.v or "", r.valid_from, r.valid_to or 0, r.is_current)
                 for r in history(rows, "k", "v", "t", "id", group_rows=group_rows).collect())
    assert got == [("a", "x", 1, 3, False), ("a", "x", 4, 0, True), ("a", "y", 3, 4, False), ("b", "", 1, 0, True)]


def test_dimension_history_in_sliced_form(spark, sf):
    want = duck_rows(duck(sf), registry.all_oracles()["merge_scd"])
    got = spark_rows(syllabus.merge_scd(spark, sf, group_rows=0))
    assert sorted(got[2], key=sort_key) == want[2]


@pytest.mark.parametrize("group_rows", [0, 10**6])
def test_late_deliveries_equal_a_rebuild(spark, group_rows):
    """Whatever is delivered when, the stored dimension is the one built from all changes at once."""
    rows = [(k, "xyz"[(k * 7 + t * t) % 3] if (k + t) % 5 else None, t, t % 4) for k in range(6) for t in range(20)]
    rows += [(9, "x", t, 0) for t in range(200)]  # one key with a long history
    rows = [r for r in rows if r[0] != 5]
    columns = "k int, v string, t int, id int"
    parts = [[r for i, r in enumerate(rows) if i * 13 % 3 == p] for p in range(3)] + [[(5, "x", 3, 1), (2, "new", -4, 0)]]
    stored = VersionedTable(spark, scratch(spark, "dim"), f"{columns}, starts boolean, valid_to int", ["k"], 4)
    stored.create(observed(spark.createDataFrame(parts[0], columns), "k", "v", "t", "id", group_rows))
    for part in (*parts[1:], parts[1], [(None, "x", 1, 1)]):  # a delivery comes twice, one has no key
        merge_history(stored, spark.createDataFrame(part, columns), "k", "v", "t", "id", group_rows)
    everything = spark.createDataFrame([r for p in parts for r in p], columns)
    want = history(everything, "k", "v", "t", "id", group_rows=group_rows)
    got = stretches(stored.read(), "k", "v", "t")
    assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).count() == 0


def test_a_delivery_rewrites_only_its_buckets(spark):
    columns = "k int, v string, t int, id int"
    stored = VersionedTable(spark, scratch(spark, "dim"), f"{columns}, starts boolean, valid_to int", ["k"], 8)
    stored.create(observed(spark.createDataFrame([(k, "a", 1, 1) for k in range(100)], columns), "k", "v", "t", "id"))
    version = merge_history(stored, spark.createDataFrame([(7, "b", 0, 1)], columns), "k", "v", "t", "id")
    assert stored._log().filter(F.col("version") == version).count() == 1
    assert merge_history(stored, spark.createDataFrame([], columns), "k", "v", "t", "id") == version
    got = sorted(tuple(r) for r in stretches(stored.read(), "k", "v", "t").filter("k = 7").collect())
    assert got == [(7, "a", 1, None, True), (7, "b", 0, 1, False)]


def test_change_feed(spark):
    feed = spark.createDataFrame([(1, "c", 1, "a"), (1, "u", 2, "b"), (2, "c", 1, "c"), (2, "d", 3, None)],
                                 "k int, op string, n int, v string")
    assert [tuple(r) for r in apply_changes(feed, "k", "n", ["v"]).collect()] == [(1, "b")]


def test_minor_then_major_equals_major(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    deltas = spark.createDataFrame(
        [(1, "x", "put", 1), (2, "y", "put", 1), (2, None, "delete", 2), (4, "z", "put", 1), (4, "w", "put", 3)],
        "id int, v string, op string, txn bigint")
    merged = merge_deltas(deltas, ["id"], ["id", "v"])
    assert merged.count() == 3
    direct = compact(base, deltas, ["id"], ["id", "v"])
    assert sorted(direct.collect()) == sorted(compact(base, merged, ["id"], ["id", "v"]).collect())
    assert sorted(tuple(r) for r in direct.collect()) == [(1, "x"), (3, "c"), (4, "w")]


def test_partials_merge_to_the_whole(spark, sf):
    events = table(spark, sf, "events").select("event_type", "event_id", "value")
    halves = [partial_totals(events.filter(F.col("event_id") % 2 == h), ["event_type"], "value") for h in (0, 1)]
    merged = merge_totals(halves[0].unionByName(halves[1]), ["event_type"])
    whole = partial_totals(events, ["event_type"], "value")
    left = {r.event_type: (r.n, r.low, r.high, round(r.total, 4)) for r in merged.collect()}
    assert left == {r.event_type: (r.n, r.low, r.high, round(r.total, 4)) for r in whole.collect()}


def test_sketch_error_is_small(spark):
    rows = spark.range(200_000).select((F.col("id") % 4).alias("part"), (F.col("id") % 50_000).alias("v"))
    estimate = merge_sketches(distinct_sketches(rows, ["part"], "v").withColumn("one", F.lit(1)), ["one"])
    assert estimate.first().distinct_estimate == pytest.approx(50_000, rel=0.03)


def test_clusters_cover_every_vector(spark, sf):
    counted = syllabus.ml_features(spark, sf).agg(F.sum("n"), F.count_distinct("cluster")).first()
    assert tuple(counted) == (table(spark, sf, "embeddings").count(), 4)


def test_quality_counts_nulls_as_failed(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "k int, v double")
    report = {r.check_name: r.failed for r in quality_report(rows, {"positive": F.col("v") > 0, "key": F.col("k") > 0}).collect()}
    assert report == {"positive": 2, "key": 0}
    assert orphans(rows, "k", spark.createDataFrame([(1,), (1,)], "p int"), "p").first().failed == 2


def test_overwrite_replaces_all_or_only_touched_partitions(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for only_touched, left in ((True, {("a", 9), ("b", 2)}), (False, {("a", 9)})):
        path = scratch(spark, "overwrite")
        write_partitioned(rows, path, ["k"])
        write_partitioned(spark.createDataFrame([("a", 9)], "k string, v int"), path, ["k"], only_touched=only_touched)
        assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == left


def test_key_range_reaches_the_sorted_files(spark, sf):
    cells = publish_sorted(staff_cells(spark, sf), scratch(spark, "pushed"))
    plan = key_range(cells, "emp:0000000010", "emp:0000000020")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,emp:0000000010)" in plan and "LessThan(row_key,emp:0000000020)" in plan
    prefix = cells.filter(F.col("row_key").startswith("emp:00000000"))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key,emp:00000000)" in prefix


def test_catalog_statistics(spark, sf):
    name = f"{fresh_database(spark)}.sales"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").format("parquet").saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} PARTITION (o_orderstatus) COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    stats = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} o_orderkey").collect()}
    assert stats["num_nulls"] == "0"
    assert int(stats["distinct_count"]) == pytest.approx(orders.count(), rel=0.1)
    one = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (o_orderstatus = 'F')").filter("col_name = 'Partition Statistics'")
    assert f"{orders.filter('o_orderstatus = \"F\"').count()} rows" in one.first().data_type
