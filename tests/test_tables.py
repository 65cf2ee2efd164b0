"""Layout on disk, catalog effects, versioned tables, incremental partitions."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weftline.adapters import emp, table
from weftline.operators.cells import publish_sorted
from weftline.operators.joins import bucketed_join
from weftline.operators.tables import (
    fill_ready_hours,
    fresh_database,
    merge_small_files,
    partition_advice,
    write_hours,
    write_bucketed,
    write_partitioned,
)
from weftline.operators.versions import VersionedTable, compact, snapshot_diff
from weftline.queries import layout
from weftline.queries.wide_cells import staff_cells
from weftline.session import scratch, shared_base
from weftline.sources.files import folder_totals, inventory, load_pairs, read_evolved, read_with_file_name, rows_per_folder, save_pairs


def data_files(path: str) -> list[Path]:
    return sorted(p for p in Path(path).rglob("part-*") if not p.name.endswith(".crc"))


def test_shared_folder_comes_from_the_session(spark):
    base = shared_base(spark)
    assert scratch(spark, "x").startswith(f"{base}/x-")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_partitioned_write(spark, sf):
    path = scratch(spark, "part")
    write_partitioned(emp(spark, sf), path, ["country"])
    folders = {p.parent.name for p in data_files(path)}
    assert folders == {f"country={r.country}" for r in emp(spark, sf).select("country").distinct().collect()}
    assert len(data_files(path)) == len(folders)


def test_merge_small_files(spark):
    many, few = scratch(spark, "many"), scratch(spark, "few")
    spark.range(1000).repartition(20).write.parquet(many)
    assert merge_small_files(spark, many, few) == 1
    assert len(data_files(few)) == 1
    size = sum(p.stat().st_size for p in data_files(many))
    split = scratch(spark, "split")
    assert merge_small_files(spark, many, split, file_bytes=size // 3) in (3, 4)
    assert spark.read.parquet(split).count() == 1000


def test_inventory_counts_every_file(spark):
    path = scratch(spark, "inv")
    spark.range(100).repartition(5).write.parquet(path)
    files = data_files(path)
    totals = folder_totals(spark, path).agg(F.sum("files"), F.sum("bytes")).first()
    assert totals[0] >= 5 and totals[1] >= sum(f.stat().st_size for f in files)
    assert inventory(spark, path).filter("path like '%part-%'").count() == 5


def test_managed_drop_deletes_and_external_drop_keeps(spark):
    db, path = fresh_database(spark, "drops"), scratch(spark, "ext")
    spark.sql(f"CREATE TABLE {db}.own (id INT) USING parquet")
    spark.sql(f"CREATE TABLE {db}.ext (id INT) USING parquet LOCATION '{path}'")
    for name in ("own", "ext"):
        spark.sql(f"INSERT INTO {db}.{name} VALUES (1), (2)")
    where = spark.sql(f"DESCRIBE FORMATTED {db}.own").filter("col_name = 'Location'").first()["data_type"]
    own = Path(where.removeprefix("file:"))
    assert own.exists()
    spark.sql(f"DROP TABLE {db}.own")
    spark.sql(f"DROP TABLE {db}.ext")
    assert not own.exists()
    assert spark.read.parquet(path).count() == 2


def test_add_and_drop_partitions(spark, sf):
    listed = {r[0] for r in layout.alter_partitions(spark, sf).collect()}
    assert "year=2030/quarter=Q3" in listed and "year=2030/quarter=Q2" not in listed


def test_repair_finds_folders(spark, sf):
    assert layout.repair_partitions(spark, sf).agg(F.sum("n")).first()[0] == table(spark, sf, "orders").count()


def test_bucket_files_equal_the_hash(spark, sf):
    orders, _, buckets = layout.bucketed_pair(spark, sf)
    assert buckets == 8
    one = layout.sample_from_bucketed(spark, sf)
    by_hash = spark.table(orders).filter(F.pmod(F.hash("o_custkey"), F.lit(8)) == 3)
    assert one.count() > 0
    assert one.select("o_orderkey").exceptAll(by_hash.select("o_orderkey")).count() == 0
    assert one.count() == by_hash.count()


def test_bucketed_join_with_hot_keys(spark):
    db = fresh_database(spark)
    big = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    write_bucketed(big, f"{db}.big", 4, "k")
    write_bucketed(spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")), f"{db}.other", 4, "k")
    left, right = spark.table(f"{db}.big"), spark.table(f"{db}.other")
    plain = left.join(right, "k").select("id", "k", "w")
    split = bucketed_join(left, right, "k", hot_rows=500).select("id", "k", "w")
    assert split.count() == plain.count() > 0
    assert split.exceptAll(plain).count() == 0
    text = split._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
    files = {p.name.split("_")[-1] for p in Path(
        spark.sql(f"DESCRIBE FORMATTED {db}.big").filter("col_name = 'Location'").first()["data_type"]
        .removeprefix("file:")).glob("part-*")}
    assert len(files) == 4


def test_codecs_change_bytes_not_rows(spark, sf):
    rows = layout.codec_sizes(spark, sf).collect()
    assert len(rows) == sum(len(c) for c in layout.CODECS.values())
    assert {r.rows_read for r in rows} == {table(spark, sf, "events").count()}
    size = {(r.format, r.codec): r.bytes for r in rows}
    assert size[("csv", "gzip")] < size[("csv", "none")]


def test_sorted_publish_is_globally_sorted(spark, sf):
    path = scratch(spark, "sorted")
    publish_sorted(staff_cells(spark, sf), path)
    spans = [
        spark.read.parquet(str(f)).agg(F.min("row_key"), F.max("row_key")).first() for f in data_files(f"{path}/loads")
    ]
    spans = [tuple(s) for s in spans if s[0] is not None]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    for f in data_files(f"{path}/loads"):
        keys = [r.row_key for r in spark.read.parquet(str(f)).collect()]
        assert keys == sorted(keys)


def test_file_names_and_pairs(spark):
    path = scratch(spark, "lines")
    spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1).write.text(path)
    assert {r.file for r in read_with_file_name(spark, path).collect()} == {data_files(path)[0].name}
    packed = scratch(spark, "pairs")
    save_pairs(spark.createDataFrame([("k", "é\tx")], "k string, v string"), "k", "v", packed)
    assert tuple(load_pairs(spark, packed, "k string, v string").first()) == ("k", "é\tx")


def test_schema_evolution_rejects_a_changed_type(spark):
    path = scratch(spark, "evolve")
    spark.range(3).write.parquet(f"{path}/g=1")
    spark.sql("SELECT 7L AS id, CAST(NULL AS DOUBLE) AS bonus").write.parquet(f"{path}/g=2")
    both = [f"{path}/g=1", f"{path}/g=2"]
    read = read_evolved(spark, both, {"id": ("bigint", None), "bonus": ("double", 1.5)})
    assert sorted((r.id, r.bonus) for r in read.collect()) == [(0, 1.5), (1, 1.5), (2, 1.5), (7, None)]  # a stored null stays
    with pytest.raises(TypeError):
        read_evolved(spark, both, {"id": ("string", None)})
    with pytest.raises(TypeError):  # a renamed column is lost where it has its old name
        read_evolved(spark, both, {"number": ("bigint", None)})


def test_partition_advice_is_one_row_per_column(spark):
    assert partition_advice(spark.range(10).selectExpr("string(id) AS id"), ["id"], 10).count() == 1


@pytest.fixture
def acid(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 10).alias("grp"), F.lit(1.0).alias("pay")).withColumn(
        "pay", F.when(F.col("id") == 5, None).otherwise(F.col("pay")))
    store = VersionedTable(spark, scratch(spark, "acid"), "id bigint, grp bigint, pay double", ["id"])
    store.create(rows)
    return store


def test_changes_rewrite_only_touched_buckets(acid):
    acid.delete(F.col("id") == 12)
    attempts = sorted(len({f.parent for f in data_files(str(p))}) for p in Path(acid.root, "data").glob("_a=*"))
    assert attempts == [1, 16]
    assert acid.read().count() == 999
    assert acid.read(0).count() == 1000


def test_lost_commits_are_never_seen(acid, monkeypatch):
    def lost(self, entries):
        raise RuntimeError("the driver is gone")

    changes = acid.spark.createDataFrame([(3, 1, 70.0), (5000, 1, 80.0)], acid.schema)
    for change in (lambda: acid.update(F.col("id") < 50, {"pay": F.lit(0.0)}), lambda: acid.delete(F.col("id") > 10),
                   lambda: acid.upsert(changes), lambda: acid.restore(0)):
        with monkeypatch.context() as patched:
            patched.setattr(VersionedTable, "_publish", lost)
            with pytest.raises(RuntimeError):
                change()
        before = acid.version
        assert acid.read().count() == (1000 if before < 2 else acid.read(before).count())
        change()
        assert acid.version == before + 1
    assert acid.read().exceptAll(acid.read(0)).count() == 0 and acid.read().count() == 1000
    assert acid.read(3).filter("id = 5000").first().pay == 80.0 and acid.read(1).filter("pay = 0").count() == 50


def test_a_read_keeps_its_version(acid):
    before = acid.read()
    acid.delete(F.lit(True))
    assert before.count() == 1000 and acid.read().count() == 0


def test_readers_prune_folders_at_run_time(acid):
    acid.delete(F.col("id") == 12)
    plan = acid.read()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan


def test_rows_per_folder(spark, sf):
    path = scratch(spark, "per-folder")
    write_partitioned(emp(spark, sf), path, ["country"])
    counted = {r.folder.rsplit("=", 1)[1]: r.n_rows for r in rows_per_folder(spark.read.parquet(path)).collect()}
    assert counted == {r.country: r["count"] for r in emp(spark, sf).groupBy("country").count().collect()}
    listed = folder_totals(spark, path)
    assert listed.count() == len(counted) and listed.filter("files < 1 OR bytes < 1").count() == 0


def test_unknown_predicates_change_nothing(acid):
    acid.delete(F.col("pay") < 0)  # null for id 5, false elsewhere
    assert acid.version == 0
    acid.update(F.col("pay") > 0, {"pay": F.col("pay") * 2})
    assert acid.read().filter("id = 5").first().pay is None
    assert acid.read().filter("pay = 2.0").count() == 999


def test_emptied_bucket_and_restore(acid):
    acid.delete(F.lit(True))
    assert acid.read().count() == 0
    acid.restore(0)
    assert acid.read().count() == 1000
    assert acid.read(1).count() == 0


def test_data_without_a_log_entry_is_invisible(spark, acid):
    """What a job leaves behind when it is lost before its commit."""
    spark.range(5).selectExpr("id", "id AS grp", "0D AS pay", "0 AS _b").write.partitionBy("_b").parquet(
        f"{acid.root}/data/_a=lost")
    assert acid.read().count() == 1000
    assert acid.version == 0


def test_upsert_replaces_and_adds(spark, acid):
    acid.upsert(spark.createDataFrame([(7, 70, 7.5), (5000, 1, 2.5)], "id bigint, grp bigint, pay double"))
    rows = {r.id: r.pay for r in acid.read().filter("id in (7, 5000)").collect()}
    assert rows == {7: 7.5, 5000: 2.5}
    assert acid.read().count() == 1001


def test_compaction(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    deltas = spark.createDataFrame(
        [(1, "x", "put", 1), (1, "y", "put", 2), (2, None, "delete", 1), (4, "d", "put", 1), (3, None, "delete", 1),
         (3, "again", "put", 2)], "id int, v string, op string, txn bigint")
    got = {r.id: r.v for r in compact(base, deltas, ["id"], ["id", "v"]).collect()}
    assert got == {1: "y", 3: "again", 4: "d"}


def test_snapshot_diff_pairs_copies_one_to_one(spark):
    old = spark.createDataFrame([("f", "v1"), ("a", "same"), ("b", "same"), ("c", "same"), ("d", "gone")], "k string, v string")
    new = spark.createDataFrame([("f", "v2"), ("x", "same"), ("y", "same"), ("extra", "new")], "k string, v string")
    for rows in (0, 100):
        diff = snapshot_diff(old, new, "k", ["v"], group_rows=rows)
        got = sorted((r.change, r.old_key or "", r.new_key or "") for r in diff.collect())
        assert got == [("+", "", "extra"), ("-", "c", ""), ("-", "d", ""), ("M", "f", "f"), ("R", "a", "x"), ("R", "b", "y")]


def test_only_ready_hours_are_filled_and_reruns_change_nothing(spark):
    root, out = scratch(spark, "hours"), scratch(spark, "filled")
    rows = spark.createDataFrame([("h1", "a"), ("h1", "b"), ("h2", "a")], "hour string, line string")

    def job(frame):
        return frame.groupBy("hour").agg(F.count("*").alias("n"))

    def fill():
        return {r.hour: r.n for r in fill_ready_hours(spark, root, out, "hour", rows.schema, job).collect()}

    write_hours(rows.filter("hour = 'h1'"), root, "hour")
    rows.filter("hour = 'h2'").write.mode("append").partitionBy("hour").parquet(f"{root}/data")  # not marked ready
    assert fill() == {"h1": 2}
    assert fill() == {"h1": 2}
    spark.createDataFrame([("h2",)], "hour string").write.mode("append").parquet(f"{root}/ready")
    assert fill() == {"h1": 2, "h2": 1}
