"""The sliced forms of the window operators must equal the plain windows, with hot groups, ties and nulls."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.compare import duck, duck_rows, sort_key, spark_rows
from weftline import registry
from weftline.operators.grouping import bags
from weftline.operators.ordered import framed, ranked, running, value_range_mean
from weftline.queries import windowing


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows share one key and a third share one value; null keys and null values occur."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 50 == 2, None).otherwise(
            (F.col("id") % 7).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, 42.0).when(F.col("id") % 41 == 1, None).otherwise(
            (F.col("id") * 7919 % 500) / 4).alias("v"),
    )


def same(left, right):
    a, b = spark_rows(left), spark_rows(right.select(*left.columns))
    assert a[0] == b[0]
    assert len(a[2]) == len(b[2])
    for x, y in zip(a[2], b[2]):
        assert x == pytest.approx(y) if all(isinstance(i, (int, float)) for i in x + y) else _near(x, y)


def _near(x, y):
    return all((p == q) or (isinstance(p, float) and abs(p - q) < 1e-6) for p, q in zip(x, y))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_ranked(skewed, keys, descending):
    plain = ranked(skewed, keys, "v", "id", descending, group_rows=10**9)
    sliced = ranked(skewed, keys, "v", "id", descending, group_rows=0)
    same(plain.withColumns({c: F.round(c, 9) for c in ("pct_rank", "cume")}),
         sliced.withColumns({c: F.round(c, 9) for c in ("pct_rank", "cume")}))


@pytest.mark.parametrize("keys", [["k"], []])
def test_running(skewed, keys):
    args = (skewed, keys, [("v", True), ("id", False)], {"s": "v"}, "pos")
    same(running(*args, group_rows=10**9), running(*args, group_rows=0))


@pytest.mark.parametrize("block", [7, 100, 10**6])
def test_framed(skewed, block):
    def build(w):
        return {"a": F.lag("v", 3).over(w), "b": F.lead("id", 2).over(w), "c": F.count("v").over(w.rowsBetween(-3, 2))}

    args = (skewed, ["k"], [("v", False), ("id", False)], build, 3, 2)
    same(framed(*args, group_rows=10**9), framed(*args, group_rows=0, block=block))


@pytest.mark.parametrize("keys", [["k"], []])
def test_value_range_mean(skewed, keys):
    rows = skewed.filter("v is not null")
    same(value_range_mean(rows, keys, "v", 5.0, "m", group_rows=10**9),
         value_range_mean(rows, keys, "v", 5.0, "m", group_rows=0))


def test_bags_are_bounded_and_whole(skewed):
    cut = bags(skewed, ["k"], [("id", False)], F.col("id"), chunk=64, group_rows=0)
    assert cut.agg(F.max(F.size("bag"))).first()[0] == 64
    back = cut.select("k", "part", F.posexplode("bag").alias("i", "id"))
    assert back.select("k", "id").exceptAll(skewed.select("k", "id")).count() == 0
    assert back.count() == skewed.count()
    hot = [r.id for r in back.filter("k = 'hot'").orderBy("part", "i").collect()]
    assert hot == sorted(hot)


@pytest.mark.parametrize(
    "name", ["rank_family", "lag_lead", "running_total", "moving_average", "cume_dist_ntile", "rows_frames",
             "range_frame_value"],
)
def test_registered_windows_in_sliced_form(spark, sf, name):
    want = duck_rows(duck(sf), registry.all_oracles()[name])
    got = spark_rows(getattr(windowing, name)(spark, sf, group_rows=0))
    assert got[0] == want[0]
    assert sorted(got[2], key=sort_key) == want[2]


def test_a_group_and_a_tie_cross_slices(spark):
    from weftline.operators.ordered import slice_rows

    rows = spark.range(4000).selectExpr("IF(id < 3600, 'hot', 'cold') AS g", "CAST(id % 40 AS DOUBLE) AS v", "id")
    sliced = slice_rows(rows, ["g"], [("v", False), ("id", False)])
    assert sliced.select("_slice").distinct().count() >= 4
    assert sliced.filter("g = 'hot'").select("_slice").distinct().count() >= 4  # one group in several slices
    crossing = sliced.groupBy("g", "v").agg(F.count_distinct("_slice").alias("n")).filter("n > 1")
    assert crossing.count() > 0  # one value in two slices
