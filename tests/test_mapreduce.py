"""User mappers and reducers: order, hot keys over many slices, pieces of batches, side files."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.compare import difference, duck
from weftline import registry
from weftline.operators import mapreduce
from weftline.operators.mapreduce import in_pieces, map_pairs, reduce_sorted
from weftline.queries.userfuncs import streaming_mapreduce


class Chain:
    """Folds the values in order: any other order, lost or doubled value gives another number."""

    def start(self):
        return (0, 1)

    def step(self, state, places, values):
        total, power = state
        for v in values.tolist():
            total, power = (total * 31 + v) % 1_000_003, power * 31 % 1_000_003
        return total, power

    def merge(self, left, right):
        return (left[0] * right[1] + right[0]) % 1_000_003, left[1] * right[1] % 1_000_003

    def finish(self, key, state):
        return key, state[0]


def folded(rows):
    chain, out = Chain(), {}
    for key, _, value in sorted(rows):
        out[key] = chain.step(out.get(key, (0, 1)), np.array([0]), np.array([value]))
    return {k: v[0] for k, v in out.items()}


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_reducer_sees_values_in_order(spark, slices):
    rows = [("hot" if i % 2 else f"k{i % 97}", (i * 7919) % 5000, i % 1000) for i in range(6000)]
    pairs = spark.createDataFrame(rows, "key string, place long, value long").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")  # a run goes on over batches
    try:
        got = {r.key: r.total for r in reduce_sorted(pairs, lambda _: Chain(), "key string, total long", slices=slices).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == folded(rows)


def test_a_hot_key_lies_in_many_slices(spark):
    pairs = spark.range(40_000).select(F.lit("one").alias("key"), F.col("id").alias("place"), F.lit(1).cast("long").alias("value"))

    class Spread(Chain):
        def start(self):
            return []

        def step(self, state, places, values):
            return [*state, len(places)]

        def merge(self, left, right):
            return [sum(left), *right] if len(left) > 1 else [*left, sum(right)]

        def finish(self, key, state):
            return key, sum(state)

    plain = reduce_sorted(pairs, lambda _: Spread(), "key string, n long", slices=20)
    assert [tuple(r) for r in plain.collect()] == [("one", 40_000)]
    ranged = pairs.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(20, "key", "place", "value", "row")
    largest = ranged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 4_000


def test_equal_pairs_null_keys_and_empty_tables(spark):
    pairs = spark.createDataFrame([("a", 1, 2)] * 500 + [(None, 1, 1)] * 5, "key string, place long, value long")
    got = reduce_sorted(pairs, lambda _: Chain(), "key string, total long", slices=5)
    assert {tuple(r) for r in got.collect()} == set(folded([("a", 1, 2)] * 500).items())
    assert reduce_sorted(pairs.limit(0), lambda _: Chain(), "key string, total long").count() == 0


def test_mapper_gets_bounded_pieces_and_its_side_file(spark):
    texts = pd.Series(["x" * 10, None, "y" * 50, "z", "", "w" * 9])
    pieces = list(in_pieces(texts, 12))
    assert [i for p in pieces for i in range(p.start, p.stop)] == list(range(6))
    assert all(texts.iloc[p].str.len().fillna(0).sum() <= 12 or p.stop - p.start == 1 for p in pieces)

    def mapper(rows, side):
        return pd.DataFrame({"key": [side["tag"]], "place": [int(rows["id"].min())], "value": [len(rows)]})

    docs = spark.range(100).select("id", F.repeat(F.lit("a"), 10).alias("text")).coalesce(1)
    pairs = map_pairs(docs, mapper, "key string, place long, value long", "text", {"tag": "t"}, chars=50)
    assert pairs.count() == 20 and pairs.agg(F.sum("value")).first()[0] == 100


def test_large_side_files_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mapreduce, "SIDE_BYTES", 100)
    with pytest.raises(ValueError, match="join it"):
        map_pairs(spark.range(1), lambda rows, side: rows, "id long", "id", "x" * 200)


@pytest.mark.parametrize("slices", [2, 50])
def test_query_with_few_and_many_slices(spark, sf, slices):
    frame = streaming_mapreduce(spark, sf, slices=slices)
    assert difference(frame, duck(sf), registry.all_oracles()["streaming_mapreduce"])[0] is None
