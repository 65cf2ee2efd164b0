"""Streaming ingestion jobs. Each drains what is there and returns what was landed."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weftline.adapters import table
from weftline.operators.tables import TARGET_FILE_BYTES, total_bytes
from weftline.registry import query
from weftline.session import scratch
from weftline.streaming import ingest

LOGS = """logs AS (SELECT event_id, ts, event_type, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END
  || ' service=' || event_type || ' id=' || CAST(event_id AS VARCHAR) AS body FROM events)"""


def log_body():
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "view", "DEBUG").otherwise("INFO")
    return F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), level, F.lit(" service="), F.col("event_type"),
        F.lit(" id="), F.col("event_id").cast("string"),
    )


def log_stream(spark, sf):
    return ingest.events_of(ingest.stream_table(spark, sf, "events"), log_body(), F.col("ts"))


def landed(spark, stream, label, **options):
    path = scratch(spark, label)
    ingest.land(stream, path, scratch(spark, f"{label}-checkpoint"), **options)
    return spark.read.format(options.get("kind", "parquet")).load(path)


@query("stream_tail_files", f"""
WITH {LOGS} SELECT CASE WHEN level = 'ERROR' THEN 'app' ELSE 'web' END AS file_group, body AS line, 1 AS times FROM logs""")
def stream_tail_files(spark, sf):
    """Two groups of log files; half of them appear after a restart. Every line arrives once, with its group."""
    root, out, checkpoint = scratch(spark, "tailed"), scratch(spark, "tail-out"), scratch(spark, "tail-checkpoint")
    lines = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", "app").otherwise("web").alias("file_group"),
        log_body().alias("value"), (F.col("event_id") % 2).alias("half"),
    )
    for half in (0, 1):
        for group in ("app", "web"):
            part = lines.filter((F.col("half") == half) & (F.col("file_group") == group)).select("value")
            part.write.mode("append").text(f"{root}/{group}")
        tail = ingest.stream_files(spark, f"{root}/*", "value string", kind="text", files_per_batch=4)
        named = tail.select(
            F.col("value").alias("line"),
            F.regexp_extract("_metadata.file_path", r"/(\w+)/[^/]+$", 1).alias("file_group"),
        )
        ingest.land(named, out, checkpoint)
    seen = spark.read.parquet(out).groupBy("file_group", "line").agg(F.count("*").cast("int").alias("times"))
    return seen


@query("stream_kafka_source", """
SELECT CASE WHEN event_type = 'error' THEN 'app-logs' ELSE 'user-events' END AS topic, event_type AS body, ts FROM events""")
def stream_kafka_source(spark, sf):
    """The consumer's own transform, fed by a file stream in the shape of topic records."""
    records = ingest.stream_table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", "app-logs").otherwise("user-events").alias("topic"),
        F.col("event_type").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
    )
    stored = landed(spark, ingest.topic_events(records), "topics")
    return stored.select(F.col("headers")["topic"].alias("topic"), "body", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("interceptor_timestamp_host_static", f"""
WITH {LOGS} SELECT body, 'production' AS env, 'collector-1' AS hostname, true AS has_time FROM logs""")
def interceptor_timestamp_host_static(spark, sf):
    stream = ingest.chain(
        log_stream(spark, sf), ingest.with_arrival_time(), ingest.with_host("collector-1"),
        ingest.with_static("env", "production"),
    )
    headers = F.col("headers")
    return landed(spark, stream, "headers").select(
        "body", headers["env"].alias("env"), headers["hostname"].alias("hostname"),
        (headers["timestamp"].cast("long") > 0).alias("has_time"),
    )


@query("interceptor_regex_filter", f"WITH {LOGS} SELECT body FROM logs WHERE NOT regexp_matches(body, '.*DEBUG.*')")
def interceptor_regex_filter(spark, sf):
    return landed(spark, ingest.chain(log_stream(spark, sf), ingest.drop_matching(".*DEBUG.*")), "filtered").select("body")


@query("interceptor_regex_extract", f"""
WITH {LOGS} SELECT event_type AS service, count(*) AS n, min(body) AS first_body FROM logs GROUP BY event_type""")
def interceptor_regex_extract(spark, sf):
    stream = ingest.chain(log_stream(spark, sf), ingest.extract_header("service", r"service=(\w+)"))
    routed = stream.withColumn("service", F.col("headers")["service"])
    return landed(spark, routed, "routed", partitions=["service"]).groupBy("service").agg(
        F.count("*").alias("n"), F.min("body").alias("first_body")
    )


@query("stream_time_partitioned_sink", f"""
WITH {LOGS} SELECT strftime(ts, '%Y-%m-%d-%H') AS slot, count(*) AS n, min(body) AS first_body FROM logs GROUP BY 1""")
def stream_time_partitioned_sink(spark, sf):
    path = scratch(spark, "by-time")
    stream = ingest.by_time(log_stream(spark, sf)).select("body", "year", "month", "day", "hour")
    ingest.land(
        stream, path, scratch(spark, "by-time-checkpoint"), ["year", "month", "day", "hour"], kind="text", codec="gzip",
    )
    back = spark.read.schema("value string, year string, month string, day string, hour string").text(path)
    return back.groupBy(F.concat_ws("-", "year", "month", "day", "hour").alias("slot")).agg(
        F.count("*").alias("n"), F.min("value").alias("first_body")
    )


@query("stream_fanout", f"""
WITH {LOGS} SELECT sink, count(*) AS n, count(DISTINCT body) AS bodies, min(body) AS first_body
FROM logs, (VALUES ('archive'), ('forward')) s(sink) GROUP BY sink""")
def stream_fanout(spark, sf):
    sinks = {name: scratch(spark, name) for name in ("archive", "forward")}
    ingest.fan_out(log_stream(spark, sf), scratch(spark, "fanout-checkpoint"), sinks)
    parts = [spark.read.parquet(p).select(F.lit(n).alias("sink"), "body") for n, p in sinks.items()]
    return parts[0].unionByName(parts[1]).groupBy("sink").agg(
        F.count("*").alias("n"), F.count_distinct("body").alias("bodies"), F.min("body").alias("first_body")
    )


@query("stream_fanin", f"""
WITH {LOGS} SELECT 'events' AS origin, count(*) AS n FROM logs UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'conversations', count(*) FROM conversations""")
def stream_fanin(spark, sf):
    """Three sources of different shape into one channel."""
    orders = ingest.stream_table(spark, sf, "orders")
    chats = ingest.stream_table(spark, sf, "conversations")
    sources = [
        log_stream(spark, sf).transform(ingest.with_static("origin", "events")),
        ingest.events_of(orders, F.col("o_orderkey").cast("string"), F.col("o_orderdate"))
        .transform(ingest.with_static("origin", "orders")),
        ingest.events_of(chats, F.col("text"), F.current_timestamp())
        .transform(ingest.with_static("origin", "conversations")),
    ]
    stored = landed(spark, reduce(lambda a, b: a.unionByName(b), sources), "fanin")
    return stored.groupBy(F.col("headers")["origin"].alias("origin")).agg(F.count("*").alias("n"))


@query("stream_multihop", f"""
WITH {LOGS} SELECT body, 'collector' AS hop1, 'aggregator' AS hop2 FROM logs WHERE level <> 'DEBUG'""")
def stream_multihop(spark, sf):
    """A collector drops debug lines and lands files, an aggregator streams those files on."""
    first = ingest.chain(
        log_stream(spark, sf), ingest.drop_matching(".*DEBUG.*"), ingest.with_static("hop1", "collector")
    )
    relay = scratch(spark, "relay")
    ingest.land(first, relay, scratch(spark, "relay-checkpoint"))
    second = ingest.stream_files(spark, relay, first.schema).transform(ingest.with_static("hop2", "aggregator"))
    headers = F.col("headers")
    return landed(spark, second, "hop2").select("body", headers["hop1"].alias("hop1"), headers["hop2"].alias("hop2"))


@query("stream_durable_recovery", f"WITH {LOGS} SELECT count(*) AS n, count(DISTINCT body) AS bodies, max(body) AS last_body FROM logs")
def stream_durable_recovery(spark, sf):
    """Stop after a sink has written and before its batch is committed, start again: nothing lost, nothing twice."""
    source, out, checkpoint = scratch(spark, "spool"), scratch(spark, "spooled"), scratch(spark, "spool-checkpoint")
    files = max(3, -(-total_bytes(spark, f"{sf}/events.parquet") // TARGET_FILE_BYTES))
    table(spark, sf, "events").repartition(files).write.parquet(source)
    schema = table(spark, sf, "events").schema
    bodies = ingest.stream_files(spark, source, schema, files_per_batch=-(-files // 3)).select(log_body().alias("body"))
    try:
        ingest.land_batches(bodies, out, checkpoint, lost_at=1)
    except StreamingQueryException:
        pass  # the planned stop
    ingest.land_batches(bodies, out, checkpoint)
    return spark.read.parquet(out).agg(
        F.count("*").alias("n"), F.count_distinct("body").alias("bodies"), F.max("body").alias("last_body")
    )
