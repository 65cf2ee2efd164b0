"""Event-time windows, stream joins and per-key state on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.streaming.ingest import drain


def timed(stream: DataFrame, delay: str, column: str = "ts") -> DataFrame:
    """Zone-less times cannot carry a watermark, so the column becomes a timestamp first."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def tumbling(stream: DataFrame, keys: list[str], width: str, column: str = "ts") -> DataFrame:
    return stream.groupBy(F.window(column, width).alias("w"), *keys)


def sliding(stream: DataFrame, keys: list[str], width: str, step: str, column: str = "ts") -> DataFrame:
    return stream.groupBy(F.window(column, width, step).alias("w"), *keys)


def sessions(stream: DataFrame, keys: list[str], gap: str, column: str = "ts") -> DataFrame:
    return stream.groupBy(F.session_window(column, gap).alias("w"), *keys)


def within(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, seconds: int, salts: int = 4
) -> DataFrame:
    """Pairs of equal key where the right event follows the left one within ``seconds``.

    Both sides carry a watermark and the time bound limits how long either side is remembered. The join is on the key, the time
    bucket of the left event and a salt, so that the state and the pairs of one key are many tasks: a left event is remembered
    once, a right one under each salt of the two buckets that its span touches.
    """
    bucket = F.floor(F.unix_micros(left_time) / (seconds * 1_000_000))
    salted = left.withColumns({"_bucket": bucket, "_salt": F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")})
    last = F.floor(F.unix_micros(right_time) / (seconds * 1_000_000))
    copied = right.withColumn("_at", F.explode(F.array(*[
        F.struct((last - back).alias("bucket"), F.lit(salt).alias("salt")) for back in (0, 1) for salt in range(salts)])))
    copied = copied.select(*right.columns, F.col("_at.bucket").alias("_to_bucket"), F.col("_at.salt").alias("_to_salt"))
    follows = (F.col(right_time) >= F.col(left_time)) & (
        F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {seconds} SECONDS"))
    together = (salted[key] == copied[key]) & (F.col("_bucket") == F.col("_to_bucket")) & (F.col("_salt") == F.col("_to_salt"))
    return salted.join(copied, together & follows).drop("_bucket", "_salt", "_to_bucket", "_to_salt")


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Per-key count and sum kept as state; in update mode every batch emits the new totals of the keys it touched.

    The built-in aggregation combines a batch before the shuffle, so a hot key costs one row per task, and no Python runs per key.
    """
    return stream.groupBy(key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def quiet_spells(stream: DataFrame, key: str, value: str, gap_seconds: int, delay_seconds: int, column: str = "ts",
                 parts: int = 8) -> DataFrame:
    """Stretches of activity per key, each emitted by a timer once the key has been silent for ``gap_seconds``.

    Rows: the key, ``start`` and ``stop`` (its first and last event), ``n``, ``total``. Events ``gap_seconds`` or more apart are in
    different stretches. A stretch is emitted, and its state dropped, when the watermark (``delay_seconds`` behind the newest
    event) has passed its last event by the gap, whether or not the key is heard of again. Append mode. A null key is a key,
    a null value adds nothing, events without a time are left out.

    Every task sums its events per key and bucket of time before the shuffle, so a hot key reaches its timer as one row per
    bucket and Arrow batch. A bucket is a part of the gap, so no silence hides in it. An event is late when its whole bucket is
    behind the watermark; timers wait one bucket longer, so an event that is not late never reaches an emitted stretch.
    """
    kind = stream.schema[key].dataType.simpleString()
    width, gap = max(1, gap_seconds * 1_000_000 // parts), gap_seconds * 1_000_000
    wait = gap + width

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = pa.Table.from_batches([batch]).group_by(["key", "bucket"]).aggregate(
                [("at", "min"), ("at", "max"), ("at", "count"), ("value", "sum")])
            yield from groups.select(["key", "bucket", "at_min", "at_max", "at_count", "value_sum"]).to_batches()

    def due(stop: int) -> int:
        return -(-(stop + wait) // 1000)

    def advance(keys: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        pieces = list(zip(*state.get, strict=True)) if state.exists else []
        for frame in frames:
            pieces += list(frame[["start", "stop", "n", "total"]].itertuples(index=False, name=None))
        spells: list[list] = []
        for start, stop, n, total in sorted((int(a), int(z), int(n), t) for a, z, n, t in pieces):
            if spells and start - spells[-1][1] < gap:
                spells[-1] = [spells[-1][0], max(spells[-1][1], stop), spells[-1][2] + n, spells[-1][3] + total]
            else:
                spells.append([start, stop, n, total])
        mark = state.getCurrentWatermarkMs()
        held = [s for s in spells if due(s[1]) > mark]  # an event that is not late may still prolong or join them
        if held:
            state.update(tuple(list(part) for part in zip(*held, strict=True)))
            state.setTimeoutTimestamp(min(due(s[1]) for s in held))
        elif state.exists:
            state.remove()
        over = [s for s in spells if due(s[1]) <= mark]
        if over:
            yield pd.DataFrame({key: pd.Series([keys[0]] * len(over), dtype=object),
                                **{c: [s[i] for s in over] for i, c in enumerate(("start", "stop", "n", "total"))}})

    events = stream.select(
        F.col(key).alias("key"), F.unix_micros(F.col(column).cast("timestamp")).alias("at"),
        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value"),
    ).filter("at IS NOT NULL").withColumn("bucket", F.floor(F.col("at") / width).cast("long"))
    fields = "start bigint, stop bigint, n bigint, total double"
    pieces = events.mapInArrow(combine, f"key {kind}, bucket bigint, {fields}")
    pieces = pieces.withColumn("closes", F.timestamp_micros((F.col("bucket") + 1) * width)).withWatermark(
        "closes", f"{delay_seconds * 1_000_000 + width} microseconds")
    spells = pieces.groupBy("key").applyInPandasWithState(
        advance, f"`{key}` {kind}, {fields}", "start array<bigint>, stop array<bigint>, n array<bigint>, total array<double>",
        "append", "EventTimeTimeout")
    return spells.select(key, F.timestamp_micros("start").alias("start"), F.timestamp_micros("stop").alias("stop"), "n", "total")


def land_updates(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> None:
    """Write every batch of updates to a folder of its own; a repeated batch replaces its folder."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    drain(
        stream.writeStream.outputMode(mode).foreachBatch(deliver).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def newest(updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The last update of every key in what `land_updates` has written: the row of the highest batch."""
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])
