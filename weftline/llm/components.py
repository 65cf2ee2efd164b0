"""Connected components of a link table by alternating star operations, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import land

ROUNDS = 60


def settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = land(edges, "edges")
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return edges, (row["n"], row["x"])


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of ``links`` (a, b) the smallest node it is connected with.

    A node with very many neighbours is only ever aggregated (minimum, with partial sums) or joined with a table that has
    one row per node, so no list of neighbours is made.
    """
    u, v = F.col("u"), F.col("v")
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, state = settled(pairs.distinct())
    for _ in range(ROUNDS):
        both = edges.select("u", "v").unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy(u.alias("k")).agg(F.min("v").alias("m"))
        large = both.join(least, u == F.col("k")).filter(v > u).select(v.alias("u"), F.least("m", u).alias("v"))
        low = large.groupBy(u.alias("k")).agg(F.min("v").alias("m"))
        small = large.join(low, u == F.col("k"))
        small = small.select(F.col("k").alias("u"), F.col("m").alias("v")).unionByName(
            small.filter(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v")))
        edges, now = settled(small.distinct())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(u.alias("node"), v.alias("root")).unionByName(
        edges.select(v.alias("node"), v.alias("root")).distinct())


def roots(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest given as (node, parent), every node once, by pointer jumping."""
    state = land(parents.select("node", F.col("parent").alias("root")), "parents")
    for _ in range(ROUNDS):
        up = state.select(F.col("node").alias("k"), F.col("root").alias("above"))
        state = land(state.join(up, F.col("root") == F.col("k"), "left").select(
            "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "parents")
        if state.filter("moved").isEmpty():
            break
    else:
        raise RuntimeError("the forest is too deep")
    return state.select("node", "root").unionByName(state.select(F.col("root").alias("node"), "root").distinct())
