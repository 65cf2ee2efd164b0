"""Answers derived by hand on small inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.fixtures import DEPARTMENTS, EMPLOYEE_SCHEMA, EMPLOYEES
from weftline.functions.numbers import mean
from weftline.functions.text import words_delimited, words_stripped, words_unicode
from weftline.functions.udfs import band_batches, blank_as_zero, clean_name, mask_email, salary_band
from weftline.operators import cells as hb
from weftline.operators.governance import allowed_columns, last_four
from weftline.operators.index import inverted_index
from weftline.operators.joins import product_with_list, salted_join
from weftline.operators.ordered import attach_group, ranked, value_range_mean
from weftline.operators.selection import route, sample_bucket, sample_bytes
from weftline.operators.tables import partition_advice
from weftline.plans.sizing import broadcast_if_small, hot_keys, largest_group
from weftline.queries.grouping import department_stats
from weftline.queries.texts import count_words
from weftline.sources.files import read_counts, split_fields


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(EMPLOYEES, EMPLOYEE_SCHEMA)


def names(frame):
    return [r["name"] for r in frame.collect()]


def test_department_stats(staff):
    got = [tuple(r) for r in department_stats(staff).collect()]
    assert got == [
        ("Engineering", 5, 95600.0, 105000.0, 88000.0, 478000.0),
        ("Marketing", 3, 75000.0, 78000.0, 72000.0, 225000.0),
        ("HR", 2, 66500.0, 68000.0, 65000.0, 133000.0),
    ]


def test_top_two_and_quartiles(staff):
    best = ranked(staff, ["department"], "salary", "emp_id", descending=True).filter("row_num <= 2")
    assert names(best.orderBy("department", "row_num")) == ["Eve", "Judy", "Grace", "Dave", "Frank", "Ivan"]
    tiles = ranked(staff, [], "salary", "emp_id", tiles=4).orderBy("salary").collect()
    assert [(r["name"], r.tile_no) for r in tiles] == [
        ("Dave", 1), ("Grace", 1), ("Bob", 1), ("Ivan", 2), ("Frank", 2), ("Carol", 2), ("Heidi", 3), ("Alice", 3),
        ("Judy", 4), ("Eve", 4),
    ]
    assert [round(r.cume, 2) for r in tiles] == [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]


@pytest.mark.parametrize("group_rows", [0, 100])
def test_range_frame(staff, group_rows):
    near = value_range_mean(staff, [], "salary", 5000.0, "m", group_rows=group_rows).orderBy("salary")
    assert [round(r.m, 2) for r in near.collect()] == [
        66500.0, 68333.33, 71666.67, 75000.0, 76500.0, 90000.0, 91666.67, 95000.0, 96500.0, 105000.0
    ]


def test_above_averages(staff):
    own = attach_group(staff, ["department"], {"m": F.avg("salary")}).filter("salary > m")
    assert sorted(names(own)) == ["Eve", "Frank", "Grace", "Judy"]


def test_join_row_counts(spark, staff):
    units = spark.createDataFrame(DEPARTMENTS, "dept_name string, division string, location string")
    on = F.col("department") == F.col("dept_name")
    counts = {how: staff.join(units, on, how).count() for how in ("inner", "left", "right", "full", "left_semi")}
    assert counts == {"inner": 10, "left": 10, "right": 11, "full": 11, "left_semi": 10}
    assert product_with_list(staff, "d", [d[0] for d in DEPARTMENTS]).count() == 40
    with pytest.raises(ValueError):
        product_with_list(staff, "d", ["x"] * 11, limit=10)


def test_word_rules(spark):
    def words(rule, text):
        frame = spark.createDataFrame([(text,)], "t string").select(F.explode(rule(F.col("t"))).alias("word"))
        return [r.word for r in frame.collect() if r.word]

    assert words(words_unicode, "Étion don't x_1, ça") == ["étion", "don", "t", "x_1", "ça"]
    assert words(words_stripped, "Don't  stop, ça") == ["dont", "stop", "a"]
    assert words(words_delimited, 'a,b ("c")\td*e') == ["a", "b", "c", "\td", "e"]
    lines = spark.createDataFrame([("hello lamp hello",), ("world lamp lamp",)], "t string")
    counted = count_words(lines.select(F.explode(words_unicode(F.col("t"))).alias("word")))
    assert {r.word: r.n for r in counted.collect()} == {"lamp": 3, "hello": 2, "world": 1}


def test_malformed_lines_are_dropped(spark):
    lines = spark.createDataFrame([("lamp\t5",), ("apache",), ("spark\t8",), ("x\ty",), ("a\t1\t2",), ("desk\t6",)], "value string")
    best = read_counts(lines).orderBy(F.desc("n"), F.desc("word")).limit(3)
    assert [tuple(r) for r in best.collect()] == [("spark", 8), ("desk", 6), ("lamp", 5)]
    people = spark.createDataFrame([(" 1 , Ann , 10 , 5 ",), ("2,Bob",), ("3,Cy,20",)], "value string")
    got = [tuple(r) for r in split_fields(people, ["id", "name", "dept", "pay"], at_least=3).collect()]
    assert got == [("1", "Ann", "10", "5"), ("3", "Cy", "20", None)]


def test_size_checks(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert largest_group(rows, ["k"], 10) == 400
    assert largest_group(rows, ["k"], 5000) == 1000  # counted only: no group can be larger
    assert [r.k for r in hot_keys(rows, "k", 100, 1000).collect()] == [0]
    assert "broadcast" in broadcast_if_small(rows, 1000)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in broadcast_if_small(rows, 999)._jdf.queryExecution().analyzed().toString().lower()


def test_inverted_index(spark):
    rows = [("a.txt", "x"), ("a.txt", "x"), ("b.txt", "x"), ("c.txt", "x"), ("c.txt", "y"), ("c.txt", "")]
    tokens = spark.createDataFrame(rows, "file string, word string")
    whole = {(r.word, r.part): r.postings for r in inverted_index(tokens).collect()}
    assert whole == {("x", 0): "a.txt:2,b.txt:1,c.txt:1", ("y", 0): "c.txt:1"}
    cut = {(r.word, r.part): r.postings for r in inverted_index(tokens, per_row=2, group_rows=0).collect()}
    assert cut == {("x", 0): "a.txt:2,b.txt:1", ("x", 1): "c.txt:1", ("y", 0): "c.txt:1"}


def test_salted_join_equals_plain_join(spark):
    big = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"))
    small = spark.range(60).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("label"))
    plain = big.join(small, "k").select("id", "k", "label")
    salted = salted_join(big, small, "k", "id", salts=8, hot_rows=1000).select("id", "k", "label")
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0


def test_salted_join_salts_hot_keys_only(spark):
    big = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1000).alias("k"))
    big = big.unionByName(spark.sql("SELECT CAST(1 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS k"))
    small = spark.range(900).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("label"))
    plain = big.join(small, "k").select("id", "k", "label")
    joined = salted_join(big, small, "k", "id")
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text
    assert joined.count() == plain.count() and joined.select("id", "k", "label").exceptAll(plain).count() == 0
    even = big.filter("id % 2 = 1")  # four rows a key: none is hot
    assert "_salt" not in salted_join(even, small, "k", "id")._jdf.queryExecution().optimizedPlan().toString()


def test_means_do_not_depend_on_the_partitioning(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7919 % 100003) / 100.0).alias("v"))
    means = {tuple(r.m for r in rows.repartition(n).groupBy("k").agg(mean("v").alias("m")).orderBy("k").collect())
             for n in range(1, 9)}
    assert len(means) == 1
    thrice = spark.createDataFrame([(0.004,), (0.004,), (None,), (0.004,)], "v double")
    assert thrice.agg(mean("v")).first()[0] == 0.004
    assert thrice.filter("v > 1").agg(mean("v")).first()[0] is None
    for bad in (1e-11, 1e20, float("nan")):
        with pytest.raises(Exception, match="no decimal with 10 digits"):
            spark.createDataFrame([(bad,)], "v double").agg(mean("v")).collect()
    assert spark.createDataFrame([(1e-11,)], "v double").agg(mean("v", 12)).first()[0] == 1e-11


def test_route(spark):
    rows = spark.createDataFrame([(1, 95.0), (2, 75.0), (3, 10.0), (4, None)], "id int, pay double")
    pay = F.col("pay")
    sent = route(rows, {"senior": pay >= 90, "mid": (pay >= 70) & (pay < 90)}, otherwise="junior")
    assert sorted((r.id, r.branch) for r in sent.collect()) == [(1, "senior"), (2, "mid"), (3, "junior")]
    twice = route(rows, {"paid": pay > 0, "senior": pay >= 90})
    assert sorted(r.branch for r in twice.filter("id = 1").collect()) == ["paid", "senior"]


def test_samples(staff):
    parts = [sample_bucket(staff, "emp_id", b, 4) for b in (1, 2, 3, 4)]
    assert sorted(r.emp_id for r in parts[0].collect()) == [4, 8]
    assert sum(p.count() for p in parts) == 10
    assert sum(sample_bucket(staff, "name", b, 3).count() for b in (1, 2, 3)) == 10
    few = sample_bytes(staff, "emp_id", ["emp_id", "name"], 17)
    assert sorted(names(few)) == ["Alice", "Bob", "Carol"]  # 6 + 4 + 6 bytes, the next name passes 17
    with pytest.raises(ValueError):
        sample_bytes(staff, "emp_id", ["name"], 14)


def test_user_functions(spark):
    rows = spark.createDataFrame([("  mary-jane  o'neil ",), ("ﬁona  ½",), (None,)], "name string")
    assert [r[0] for r in rows.select(clean_name(F.col("name"))).collect()] == ["Mary-Jane Oneil", "Fiona", None]
    masked = spark.sql("SELECT 'alice@example.com' AS a").select(mask_email(F.col("a"))).first()[0]
    assert masked == "a***@example.com"
    pay = spark.createDataFrame([("a", "9000"), ("b", "8000"), ("c", "5000"), ("d", "")], "name string, salary string")
    scripted = pay.mapInPandas(band_batches, "name string, salary double, band string, tax_rate double")
    native = pay.select("name", blank_as_zero(F.col("salary")).alias("salary")).withColumn(
        "band", salary_band(F.col("salary")))
    assert [tuple(r)[:3] for r in scripted.collect()] == [tuple(r) for r in native.collect()]


def test_masks_and_rules(spark):
    shown = spark.createDataFrame([(7,), (123456,)], "k bigint").select(last_four(F.col("k"))).collect()
    assert [r[0] for r in shown] == ["XXXX-XXXX-0007", "XXXX-XXXX-3456"]
    assert allowed_columns(["a", "b", "c"], [("allow", "*"), ("deny", "b"), ("allow", "b")]) == ["a", "c"]
    assert allowed_columns(["a", "b"], [("allow", "a")]) == ["a"]


def test_partition_advice(spark):
    rows = spark.range(1000).select((F.col("id") % 4).alias("few"), "id", F.lit(1).alias("one"))
    advice = {r.column_name: r.rating for r in partition_advice(rows.select(*[F.col(c).cast("string").alias(c)
              for c in rows.columns]), rows.columns, 4 * 200 * 1024 * 1024).collect()}
    assert advice == {"few": "good", "id": "partitions too small", "one": "no pruning"}


PUTS = [
    ("E001", "name", "Alice", 1), ("E001", "dept", "Engineering", 1), ("E001", "salary", "95000", 1),
    ("E002", "name", "Bob", 1), ("E002", "dept", "Marketing", 1), ("E002", "salary", "72000", 1),
    ("E002", "salary", "75000", 5),
    ("E003", "name", "Carol", 1), ("E003", "dept", "Engineering", 1), ("E003", "salary", "105000", 1),
    ("E004", "name", "Dave", 1), ("E004", "salary", "65000", 1),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(k, "cf", q, t, t, v) for k, q, v, t in PUTS]
    return spark.createDataFrame(rows, "row_key string, family string, qualifier string, t int, seq int, value string"
                                 ).withColumn("version_ts", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")


def keys(frame):
    return sorted({r.row_key for r in frame.collect()})


def test_cell_reads(log):
    assert hb.latest(log).filter("row_key = 'E002' AND qualifier = 'salary'").first().value == "75000"
    salary = log.filter("row_key = 'E002' AND qualifier = 'salary'")
    assert [r.value for r in hb.versions(salary, 3).orderBy("version_no").collect()] == ["75000", "72000"]
    assert keys(hb.first_rows(log, 2)) == ["E001", "E002"]
    assert hb.first_rows(log, 2).count() == 6
    assert keys(hb.key_range(log, "E001", "E003")) == ["E001", "E002"]
    assert [r.qualifier for r in hb.column_page(log, 1, 1).orderBy("row_key").collect()] == ["name", "name", "name", "salary"]


def test_cell_filters(log):
    dept = {("cf", "dept"): F.col("value") == "Engineering"}
    assert keys(hb.rows_matching(log, dept)) == ["E001", "E003", "E004"]  # a row without the column passes
    assert keys(hb.rows_matching(log, dept, filter_if_missing=True)) == ["E001", "E003"]
    both = {**dept, ("cf", "name"): F.col("value") == "Carol"}
    assert keys(hb.rows_matching(log, both, filter_if_missing=True)) == ["E003"]
    either = {("cf", "name"): F.col("value") == "Bob", ("cf", "salary"): F.col("value") == "65000"}
    assert keys(hb.rows_matching(log, either, mode="or", filter_if_missing=True)) == ["E002", "E004"]


def test_tombstones(spark, log):
    marks = spark.createDataFrame(
        [("E001", "cf", "salary", 3, None, "delete_column"), ("E002", "cf", "salary", 3, None, "delete_column"),
         ("E003", None, None, 3, None, "delete_row"), ("E004", None, None, 0, None, "delete_row")],
        "row_key string, family string, qualifier string, seq int, value string, op string",
    ).withColumn("version_ts", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    seen = hb.visible(log.withColumn("op", F.lit("put")).unionByName(marks))
    got = {(r.row_key, r.qualifier): r.value for r in seen.collect()}
    assert ("E001", "salary") not in got and ("E001", "name") in got
    assert got[("E002", "salary")] == "75000"  # put again after the delete
    assert not any(k == "E003" for k, _ in got)
    assert ("E004", "name") in got  # the mark is older than the puts


def test_wide_and_back(spark, log):
    mapping = {c: ("cf", c) for c in ("name", "dept", "salary")}
    wide = hb.to_wide(log, mapping)
    assert wide.filter("row_key = 'E004'").first().dept is None
    back = hb.to_cells(wide, "row_key", mapping)
    assert back.count() == 11  # no cell for the missing department
    assert back.exceptAll(hb.latest(log).select("row_key", "family", "qualifier", "value")).count() == 0


def test_keys(spark):
    one = spark.sql("SELECT 'user:1' AS k, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS a, TIMESTAMP_NTZ '2024-01-02 00:00:00' AS b")
    row = one.select(
        hb.newest_first_key(F.col("k"), F.col("a")).alias("old"), hb.newest_first_key(F.col("k"), F.col("b")).alias("new"),
        hb.region_of(F.lit("b"), ["a", "b", "c"]).alias("region"),
    ).first()
    assert row.new < row.old
    assert row.region == 2
    deltas = spark.createDataFrame([("p", "c", "v", 1), ("p", "c", "v", 1), ("p", "c", "v", 5)],
                                   "row_key string, family string, qualifier string, delta int")
    assert hb.increment(deltas).first().counter == 7


def test_means_keep_small_values(spark):
    from weftline.functions.numbers import mean

    rows = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "v double")
    assert rows.agg(mean("v").alias("m")).first().m == pytest.approx(0.004)


def test_surrogate_keys_tell_nulls_and_separators_apart(spark):
    from weftline.operators.warehouse import surrogate_key

    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|1:b", None, None), ("a", "b", ""), (None, "null", "b")],
                                 "x string, y string, z string")
    keys = rows.select(surrogate_key(F.col("x"), F.col("y"), F.col("z")).alias("k")).collect()
    assert len({r.k for r in keys}) == 5 and all(len(r.k) == 32 for r in keys)
