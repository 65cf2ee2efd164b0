"""Nearest neighbours by a forest of hash prefixes.

Each tree gives a vector a long string of hash bits (sides of random hyperplanes) and keeps the strings sorted, so the
vectors that share a prefix with a query are one range of the array, found by binary search. A search descends in every
tree to the longest prefix that matches, then ascends in all trees in step, to shorter prefixes, until the ranges hold
enough candidates; these are scored exactly.

The forest is held in blocks of the index, so that a block with its sorted arrays fits in a task. Every query visits every
block, and the best of all blocks are merged. Equal vectors are one entry with their smallest ids, as many as a result can
need, so a vector that very many rows share costs no more than another.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from weftline.session import land

TREES = 10
BITS = 32
NEAREST = 20
INDEX_BLOCK, QUERY_BLOCK, LEAST_BLOCKS = 16_384, 4_096, 8
#: How many candidates the trees must offer together, as a share of the block, is chosen on a sample of at most so many
#: rows and queries: the smallest share that finds TARGET of the true neighbours.
SAMPLE_INDEX, SAMPLE_QUERIES, TARGET = 16_384, 64, 0.95
SHARES = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.85, 1.0, 1.2, 1.5, 2.0, 3.0, 5.0)


def planes(dim: int) -> np.ndarray:
    return np.random.default_rng(1234).normal(size=(dim + 1, TREES * BITS))


def strings(x: np.ndarray, sides: np.ndarray, longest: float | None) -> np.ndarray:
    """Hash strings, trees x rows. The largest inner product becomes the smallest angle by one more coordinate that makes
    all index vectors equally long; a query (``longest`` None) has zero there."""
    more = np.zeros(len(x)) if longest is None else np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    bits = (np.hstack([x, more[:, None]]) @ sides > 0).reshape(len(x), TREES, BITS)
    return (bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).T


@dataclass
class Forest:
    order: np.ndarray
    sorted: np.ndarray

    @classmethod
    def build(cls, codes: np.ndarray) -> Forest:
        order = np.argsort(codes, axis=1, kind="stable")
        return cls(order, np.take_along_axis(codes, order, axis=1))

    def ranges(self, codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query the range of entries that share the first ``depth`` bits."""
        low = codes >> (BITS - depth) << (BITS - depth)
        high = low + (1 << (BITS - depth))
        return (np.stack([np.searchsorted(s, x, "left") for s, x in zip(self.sorted, low, strict=True)]),
                np.stack([np.searchsorted(s, x, "left") for s, x in zip(self.sorted, high, strict=True)]))

    def candidates(self, codes: np.ndarray, enough: int):
        """Yields the entries for each query: all trees ascend together from the longest matching prefix."""
        n = codes.shape[1]
        low, high = np.zeros((TREES, n), np.int64), np.full((TREES, n), self.sorted.shape[1])
        wanting = np.ones(n, bool)
        for depth in range(BITS, 0, -1):
            some = np.flatnonzero(wanting)
            if not len(some):
                break
            a, b = self.ranges(codes[:, some], depth)
            done = (b - a).sum(axis=0) >= enough
            low[:, some[done]], high[:, some[done]] = a[:, done], b[:, done]
            wanting[some[done]] = False
        for q in range(n):
            taken = np.zeros(self.sorted.shape[1], bool)
            for order, a, b in zip(self.order, low[:, q], high[:, q], strict=True):
                taken[order[a:b]] = True
            yield np.flatnonzero(taken)


def best(x: np.ndarray, ids: list[list[int]], queries: np.ndarray, own: np.ndarray, sides: np.ndarray, longest: float,
         share: float) -> list[tuple[int, int, float]]:
    """The nearest rows of one block for each query: (query id, row id, inner product)."""
    forest = Forest.build(strings(x, sides, longest))
    enough = int(np.ceil(share * len(x))) + NEAREST
    out = []
    first = np.array([i[0] for i in ids])
    for q, found in enumerate(forest.candidates(strings(queries, sides, None), enough)):
        scores = x[found] @ queries[q]
        if len(found) > NEAREST + 1:  # ties at the last place all stay until ids decide
            bar = np.partition(scores, len(found) - NEAREST - 1)[len(found) - NEAREST - 1]
            found, scores = found[scores >= bar], scores[scores >= bar]
        rows = [(-s, i) for s, at in sorted(zip(-scores, found, strict=True), key=lambda r: (r[0], first[r[1]]))
                for i in ids[at] if i != own[q]]
        rows.sort(key=lambda r: (-r[0], r[1]))
        out.extend((int(own[q]), i, float(s)) for s, i in rows[:NEAREST])
    return out


def usable(rows: DataFrame) -> DataFrame:
    """Distinct (vec_id, v) that take part: no null id, no null, non-finite or only zero components, and of the most
    common length (of two equally common lengths the larger)."""
    v = F.col("embedding").cast("array<double>")
    good = rows.select("vec_id", v.alias("v")).filter(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0))
    dims = good.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return good.filter(F.size("v") == (dims["dim"] if dims else -1)).select("vec_id", F.transform(
        "v", lambda c: c + F.lit(0.0)).alias("v")).distinct()


def calibrate(index: DataFrame, queries: DataFrame, longest: float) -> float:
    """The share of candidates, measured against brute force on a bounded sample in hash order."""
    entries = index.orderBy(F.xxhash64("v"), "v").limit(SAMPLE_INDEX).select("v").toPandas()
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_QUERIES).select("v").toPandas()
    if not len(asked) or len(entries) <= 4 * NEAREST:
        return SHARES[-1]
    x, q = np.stack(entries["v"]), np.stack(asked["v"])
    sides = planes(x.shape[1])
    truth = x @ q.T
    nearest = [set(np.argsort(-truth[:, k], kind="stable")[:NEAREST].tolist()) for k in range(len(q))]
    forest, codes = Forest.build(strings(x, sides, longest)), strings(q, sides, None)
    for share in SHARES:
        found = sum(len(nearest[k] & set(c.tolist())) for k, c in enumerate(
            forest.candidates(codes, int(np.ceil(share * len(x))) + NEAREST)))
        if found >= TARGET * NEAREST * len(q):
            return share
    return SHARES[-1]


FOUND = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])


def search(rows: DataFrame, asked: DataFrame, share: float | None = None) -> DataFrame:
    """The nearest rows for each row of ``asked``: query_id, rank (from 1), vec_id, score.

    Nearness is the inner product in double precision, ties go to the smaller id; a row with the query's id is no
    candidate. Vectors that take no part (see `usable`) are neither queries nor candidates. Repeated rows count once.
    """
    every = land(usable(rows), "vectors")
    queries = land(usable(asked).join(every.select(F.size("v").alias("d")).limit(1), F.size("v") == F.col("d"), "left_semi"),
                   "queries")
    alike = W.partitionBy("v").orderBy("vec_id")
    index = land(every.withColumn("at", F.row_number().over(alike)).filter(F.col("at") <= NEAREST + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")), "index")
    n = index.agg(F.count("*").alias("n"), F.sqrt(F.max(F.aggregate(
        "v", F.lit(0.0), lambda a, c: a + c * c))).alias("longest")).first()
    asked_n = queries.count()
    longest = float(n["longest"] or 1.0)
    share = calibrate(index, queries, longest) if share is None else share
    blocks = max(LEAST_BLOCKS, -(-n["n"] // INDEX_BLOCK))
    rounds = max(1, -(-asked_n // QUERY_BLOCK))
    left = index.select(F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("long").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("j"),
                        "v", "ids")
    right = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("i"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(rounds)).cast("int").alias("j"), "vec_id", "v")

    def visit(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        x = np.stack(block["v"])
        found = best(x, [list(i) for i in block["ids"]], np.stack(queries["v"]), queries["vec_id"].to_numpy(),
                     planes(x.shape[1]), longest, share)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(visit, FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEAREST).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
