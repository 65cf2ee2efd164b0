"""User mappers and reducers in Python over key-sorted partitions.

A mapper turns batches of rows into (key, place, value) pairs. A reducer sees the values of a key in the order of their places,
a piece at a time, and keeps a state between pieces. Pairs are range-partitioned on (key, place), so a hot key lies in several
slices; each slice reduces its part of the key, and the few keys at slice edges are merged afterwards in slice order. A reducer
may therefore depend on the order of values, as long as the states of two neighbouring stretches can be merged. No key is ever
held in one frame.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.session import land

#: Bytes of a side file at most: it is read into every Python worker.
SIDE_BYTES = 25_000_000


class Reducer(Protocol):
    def start(self) -> Any: ...

    def step(self, state: Any, places: np.ndarray, values: np.ndarray) -> Any:
        """The state after some more values of the key, in order."""

    def merge(self, left: Any, right: Any) -> Any:
        """The state of two stretches of a key, the right one behind the left one."""

    def finish(self, key: Any, state: Any) -> tuple:
        """The row of a key."""


def ship(df: DataFrame, side: Any):
    """A side file or parameters, sent to every executor once."""
    size = len(pickle.dumps(side))
    if size > SIDE_BYTES:
        raise ValueError(f"the side file has {size} bytes, at most {SIDE_BYTES} may be sent to all tasks: join it instead")
    return df.sparkSession.sparkContext.broadcast(side)


def in_pieces(texts: pd.Series, chars: int) -> Iterator[slice]:
    """Stretches of a batch whose texts have about ``chars`` characters together; a longer text is a stretch of its own."""
    ends = texts.str.len().fillna(0).cumsum().to_numpy()
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + chars, side="right")))
        yield slice(start, stop)
        start = stop


def map_pairs(df: DataFrame, mapper: Callable[[pd.DataFrame, Any], pd.DataFrame], schema: str, text: str, side: Any = None,
              chars: int = 4_000_000) -> DataFrame:
    """Pairs ``schema`` (key, place, value) that ``mapper(rows, side)`` makes of every stretch of rows.

    A stretch has at most ``chars`` characters of ``text``, whatever the size of an Arrow batch. An empty table has no pairs.
    """
    shared = ship(df, side)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece in in_pieces(batch[text], chars):
                yield mapper(batch.iloc[piece], shared.value)

    return df.mapInPandas(run, schema)


def reduce_sorted(pairs: DataFrame, make: Callable[[Any], Reducer], schema: str, side: Any = None,
                  slices: int | None = None) -> DataFrame:
    """One row ``schema`` per key of ``pairs`` (key, place, value). ``make(side)`` builds the reducer once per task.

    Values of equal place come in the order of the values; equal pairs are interchangeable and may be in several slices. Null
    keys are left out, null places and values come first. An empty table gives an empty table.
    """
    spark = pairs.sparkSession
    shared = ship(pairs, side)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored first: finding the ranges reads the pairs a second time
    rows = land(pairs.filter(F.col("key").isNotNull()).withColumn("row", F.monotonically_increasing_id()), "pairs")
    order = ["key", "place", "value", "row"]
    ranged = rows.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())
    out = StructType.fromDDL(schema)
    names = [f"o{i}" for i in range(len(out))]
    kind = dict(pairs.dtypes)["key"]

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reducer = make(shared.value)
        key = state = number = None
        runs = 0  # of this slice, the open one included

        def row(edge: bool) -> tuple:
            if edge:
                return (key, number, pickle.dumps(state), *[None] * len(names))
            return (None, None, None, *reducer.finish(key, state))

        for batch in batches:
            if not len(batch):
                continue
            keys, places, values = (batch[c].to_numpy() for c in ("key", "place", "value"))
            number = int(batch["slice"].iloc[0])
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            closed = []
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
                if not runs or keys[start] != key:
                    if runs:
                        closed.append(row(edge=runs == 1))
                    key, state, runs = keys[start], reducer.start(), runs + 1
                state = reducer.step(state, places[start:stop], values[start:stop])
            if closed:
                yield pd.DataFrame(closed, columns=["key", "slice", "state", *names], dtype=object)
        if runs:
            yield pd.DataFrame([row(edge=True)], columns=["key", "slice", "state", *names], dtype=object)

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, out, strict=True))
    done = land(ranged.mapInPandas(reduced, f"key {kind}, slice int, state binary, {fields}"), "reduced")
    # a key at an edge has at most one state per slice
    edges = done.filter("state is not null").groupBy("key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slice", "state"))), lambda s: s["state"]).alias("states"))

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reducer = make(shared.value)
        for batch in batches:
            finished = []
            for key, states in zip(batch["key"].to_numpy(), batch["states"], strict=True):
                state = pickle.loads(states[0])
                for later in states[1:]:
                    state = reducer.merge(state, pickle.loads(later))
                finished.append(reducer.finish(key, state))
            yield pd.DataFrame(finished, columns=names, dtype=object)

    whole = done.filter("state is null").select(*names).unionByName(edges.mapInPandas(merged, fields))
    return whole.select(*[F.col(n).alias(f.name) for n, f in zip(names, out, strict=True)])
