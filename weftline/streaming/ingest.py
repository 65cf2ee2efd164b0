"""Event ingestion on Structured Streaming: sources, header interceptors, landing sinks.

An event is (body string, headers map<string,string>, ts timestamp). Interceptors are functions from frame to frame, so
the same code serves a batch and a stream. A channel is a checkpoint: offsets are logged before and after each batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from weftline.operators.tables import by_partition

Transform = Callable[[DataFrame], DataFrame]
ROLL_ROWS = 1_000_000
#: Bytes of input files in one batch.
BATCH_BYTES = 64 * 1024**3


def stream_files(
    spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", files_per_batch: int | None = None,
    bytes_per_batch: int = BATCH_BYTES,
) -> DataFrame:
    """New files of a folder, each read once; the checkpoint of the query remembers which.

    A batch is bounded by ``bytes_per_batch``, or by a number of files where one is given.
    """
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables as a stream.

    The table may be one file or a folder of files. As a pattern the path is accepted for both; a plain path to a
    single file is refused by the file source.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return stream_files(spark, f"{sf_dir}/{name}.parque[t]", schema)


def stream_topics(
    spark: SparkSession, servers: str, topics: list[str], starting: str = "latest", rows_per_batch: int = 1_000_000
) -> DataFrame:
    """Several topics as one event stream with the topic in the headers. Needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", rows_per_batch)
        .load()
    )
    return topic_events(raw)


def topic_events(raw: DataFrame) -> DataFrame:
    """(topic, value, timestamp) records as events with a topic header."""
    return raw.select(
        F.col("value").cast("string").alias("body"),
        F.create_map(F.lit("topic"), F.col("topic")).alias("headers"),
        F.col("timestamp").alias("ts"),
    )


def events_of(df: DataFrame, body: Column, ts: Column) -> DataFrame:
    none = F.create_map().cast("map<string,string>")
    return df.select(body.alias("body"), none.alias("headers"), ts.cast("timestamp").alias("ts"))


def with_header(name: str, value: Column) -> Transform:
    """Set a header, replacing an earlier value."""

    def apply(df: DataFrame) -> DataFrame:
        others = F.map_filter("headers", lambda key, _: key != F.lit(name))
        return df.withColumn("headers", F.map_concat(others, F.create_map(F.lit(name), value.cast("string"))))

    return apply


def with_arrival_time() -> Transform:
    return with_header("timestamp", F.unix_millis(F.current_timestamp()))


def with_host(host: str) -> Transform:
    return with_header("hostname", F.lit(host))


def with_static(name: str, value: str) -> Transform:
    return with_header(name, F.lit(value))


def drop_matching(pattern: str) -> Transform:
    return lambda df: df.filter(~F.col("body").rlike(pattern))


def keep_matching(pattern: str) -> Transform:
    return lambda df: df.filter(F.col("body").rlike(pattern))


def extract_header(name: str, pattern: str) -> Transform:
    """First group of ``pattern`` in the body as a header; bodies without a match get no header."""

    def apply(df: DataFrame) -> DataFrame:
        found = F.regexp_extract("body", pattern, 1)
        tagged = with_header(name, found)(df)
        return tagged.withColumn("headers", F.map_filter("headers", lambda k, v: ~((k == F.lit(name)) & (v == ""))))

    return apply


def chain(df: DataFrame, *steps: Transform) -> DataFrame:
    for step in steps:
        df = step(df)
    return df


def by_time(df: DataFrame) -> DataFrame:
    """Landing partitions from the event time."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.withColumns({name: F.date_format("ts", fmt) for name, fmt in parts.items()})


def drain(query: StreamingQuery) -> None:
    """Wait until everything available has been processed; a failure of the query is raised here."""
    query.awaitTermination()


def land(
    stream: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None, kind: str = "parquet",
    codec: str | None = None, roll_rows: int = ROLL_ROWS,
) -> None:
    """Append the available data to files, exactly once (the sink keeps a log of committed files).

    A file is closed at the end of its batch or after ``roll_rows`` rows. Rows of one partition are brought together
    before the write and split again where there are too many for one task.
    """
    if partitions:
        stream = by_partition(stream, *partitions)
    writer = stream.writeStream.format(kind).option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.option("maxRecordsPerFile", roll_rows)
    if codec:
        writer = writer.option("compression", codec)
    if partitions:
        writer = writer.partitionBy(*partitions)
    drain(writer.trigger(availableNow=True).start())


def fan_out(stream: DataFrame, checkpoint: str, sinks: dict[str, str]) -> None:
    """Replicate a stream to several folders.

    A batch may be delivered again after a failure, so every sink replaces its own folder of that batch. The batch is computed
    once, into a landing beside the checkpoint, and the sinks copy from there; nothing is kept in the memory of executors.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        landing = f"{checkpoint}-landing/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(landing)
        landed = batch.sparkSession.read.schema(batch.schema).parquet(landing)
        for path in sinks.values():
            landed.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    drain(
        stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def land_batches(stream: DataFrame, path: str, checkpoint: str, lost_at: int | None = None) -> None:
    """Write every batch to a folder of its own; a repeated batch replaces its folder.

    ``lost_at`` stops the run after the sink of that batch has written and before the batch is committed, as a lost driver would.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if batch_id == lost_at:
            raise RuntimeError("stopped between sink and commit")

    drain(
        stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
