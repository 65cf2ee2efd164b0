"""Topics beyond the core jobs: set algebra, subqueries, history, event time, quality, features."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weftline.adapters import EMP, SALES, emp, sales, table
from weftline.operators.grouping import CHUNK_ROWS, bags
from weftline.operators.rollups import (
    distinct_sketches,
    merge_sketches,
    merge_totals,
    partial_totals,
    rollup_totals,
)
from weftline.operators.tables import bucket_count, total_bytes
from weftline.operators.versions import VersionedTable
from weftline.operators.warehouse import (
    apply_changes,
    duplicate_keys,
    merge_history,
    observed,
    orphans,
    quality_report,
    surrogate_key,
)
from weftline.operators.warehouse import stretches as stretches_of
from weftline.plans.sizing import settle
from weftline.registry import query
from weftline.session import land, scratch
from weftline.streaming import eventtime, ingest


@query("intersect_except", """
WITH a AS (SELECT user_id FROM events WHERE event_type = 'purchase'), b AS (SELECT user_id FROM events WHERE event_type = 'error' AND value > 30)
SELECT 'both' AS op, user_id FROM (SELECT user_id FROM a INTERSECT SELECT user_id FROM b)
UNION ALL SELECT 'only', user_id FROM (SELECT user_id FROM a EXCEPT SELECT user_id FROM b)
UNION ALL SELECT 'any', user_id FROM (SELECT user_id FROM a UNION SELECT user_id FROM b)
UNION ALL SELECT 'surplus', user_id FROM (SELECT user_id FROM a EXCEPT ALL SELECT user_id FROM b)""")
def intersect_except(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "value")
    a = events.filter("event_type = 'purchase'").select("user_id")
    b = events.filter("event_type = 'error' AND value > 30").select("user_id")
    results = {"both": a.intersect(b), "only": a.subtract(b), "any": a.union(b).distinct(), "surplus": a.exceptAll(b)}
    parts = [frame.select(F.lit(op).alias("op"), "user_id") for op, frame in results.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


SUBQUERIES = """
SELECT c_custkey, c_name,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) AS has_big,
  c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS has_purchase,
  NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS none_pending
FROM customer
WHERE c_acctbal > (SELECT avg(s_acctbal) FROM supplier WHERE s_nationkey = c_nationkey)"""


@query("exists_in_correlated", SUBQUERIES)
def exists_in_correlated(spark, sf):
    for name in ("customer", "orders", "events", "supplier"):
        table(spark, sf, name).createOrReplaceTempView(f"weft_sq_{name}")
    text = SUBQUERIES
    for name in ("customer", "orders", "events", "supplier"):
        text = text.replace(f"FROM {name}", f"FROM weft_sq_{name}")
    return spark.sql(text)


@query("lateral_join", """
SELECT c_custkey, o.n, o.top_price FROM customer, LATERAL (
  SELECT count(*) AS n, max(o_totalprice) AS top_price FROM orders WHERE o_custkey = c_custkey) o""")
def lateral_join(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("weft_lat_customer")
    table(spark, sf, "orders").createOrReplaceTempView("weft_lat_orders")
    return spark.sql("""
        SELECT c_custkey, o.n, o.top_price FROM weft_lat_customer, LATERAL (
          SELECT count(*) AS n, max(o_totalprice) AS top_price FROM weft_lat_orders WHERE o_custkey = c_custkey) o""")


@query("nth_value", f"""
WITH {EMP} SELECT emp_id, department, salary, nth_value(salary, 2) OVER (PARTITION BY department ORDER BY salary DESC, emp_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_salary FROM emp""")
def nth_value(spark, sf, n: int = 2):
    """The n-th row per group comes from a pushed-down top n; one value per group is then joined back."""
    rows = emp(spark, sf).select("emp_id", "department", "salary")
    best_first = W.partitionBy("department").orderBy(F.desc("salary"), "emp_id")
    nth = rows.withColumn("rn", F.row_number().over(best_first)).filter(F.col("rn") <= n).filter(F.col("rn") == n)
    second = settle(nth.select(F.col("department").alias("of"), F.col("salary").alias("second_salary")))
    return rows.join(second, F.col("department").eqNullSafe(F.col("of")), "left").drop("of")


TREE = """
  edges AS (SELECT 'r' || CAST(r_regionkey AS VARCHAR(20)) AS node, 'world' AS parent FROM region
    UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR(20)), 'r' || CAST(n_regionkey AS VARCHAR(20)) FROM nation
    UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR(20)), 'n' || CAST(c_nationkey AS VARCHAR(20)) FROM customer),
  walk(node, depth, path) AS (SELECT node, 1, node FROM edges WHERE parent = 'world'
    UNION ALL SELECT e.node, w.depth + 1, w.path || '/' || e.node FROM edges e JOIN walk w ON e.parent = w.node)
SELECT node, depth, path FROM walk"""


@query("recursive_cte", f"WITH RECURSIVE {TREE}")
def recursive_cte(spark, sf):
    text = f"WITH RECURSIVE {TREE}"
    for name in ("region", "nation", "customer"):
        table(spark, sf, name).createOrReplaceTempView(f"weft_tree_{name}")
        text = text.replace(f"FROM {name}", f"FROM weft_tree_{name}")
    return spark.sql(text)


@query("pivot_unpivot", f"""
WITH {SALES}, wide AS (SELECT year, round(sum(amount) FILTER (WHERE quarter = 'Q1'), 2) AS q1, round(sum(amount) FILTER (WHERE quarter = 'Q2'), 2) AS q2,
  round(sum(amount) FILTER (WHERE quarter = 'Q3'), 2) AS q3, round(sum(amount) FILTER (WHERE quarter = 'Q4'), 2) AS q4 FROM sales GROUP BY year)
SELECT 'wide' AS form, year, NULL AS quarter, NULL AS amount, q1, q2, q3, q4 FROM wide
UNION ALL SELECT 'long', year, quarter, amount, NULL, NULL, NULL, NULL FROM (
  SELECT year, unnest(['q1', 'q2', 'q3', 'q4']) AS quarter, unnest([q1, q2, q3, q4]) AS amount FROM wide) WHERE amount IS NOT NULL""")
def pivot_unpivot(spark, sf):
    quarters = ["Q1", "Q2", "Q3", "Q4"]
    wide = sales(spark, sf).groupBy("year").pivot("quarter", quarters).agg(F.round(F.sum("amount"), 2))
    wide = wide.select("year", *[F.col(q).alias(q.lower()) for q in quarters])
    names = [q.lower() for q in quarters]
    long = wide.unpivot(["year"], names, "quarter", "amount").filter("amount is not null")
    return wide.select(F.lit("wide").alias("form"), "*").unionByName(
        long.select(F.lit("long").alias("form"), "*"), allowMissingColumns=True
    )


@query("null_functions", f"""
WITH {EMP} SELECT emp_id, coalesce(nullif(department, 'MACHINERY'), 'none') AS department,
  greatest(salary, 0.0, 1000.0) AS at_least, least(salary, 5000.0) AS at_most, nullif(country, 'NATION_0') AS country FROM emp""")
def null_functions(spark, sf):
    return emp(spark, sf).select(
        "emp_id",
        F.coalesce(F.nullif(F.col("department"), F.lit("MACHINERY")), F.lit("none")).alias("department"),
        F.greatest("salary", F.lit(0.0), F.lit(1000.0)).alias("at_least"),
        F.least("salary", F.lit(5000.0)).alias("at_most"),
        F.nullif(F.col("country"), F.lit("NATION_0")).alias("country"),
    )


@query("json_and_complex_types", """
WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, string_split(event_type || ',' || strftime(ts, '%m,%d'), ',') AS parts FROM events)
SELECT event_id, k, CAST(unnest(range(len(parts))) AS INTEGER) AS place, unnest(parts) AS part, CAST(len(parts) AS INTEGER) AS size, parts[1] AS kind FROM e""")
def json_and_complex_types(spark, sf):
    parsed = table(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.flatten(
            F.array(F.array("event_type"), F.split(F.date_format("ts", "MM,dd"), ","))
        ).alias("parts"),
    )
    named = parsed.withColumn("m", F.create_map(F.lit("kind"), F.element_at("parts", 1)))
    return named.select(
        "event_id", "k", F.posexplode("parts").alias("place", "part"), F.size("parts").alias("size"),
        F.col("m")["kind"].alias("kind"),
    )


@query("merge_scd", """
WITH c AS (SELECT o_custkey AS custkey, o_orderpriority AS priority, o_orderdate AS since, o_orderkey AS tie FROM orders),
s AS (SELECT * FROM (SELECT *, lag(priority) OVER (PARTITION BY custkey ORDER BY since, tie) AS before FROM c) WHERE before IS NULL OR before <> priority),
two AS (SELECT custkey, priority, since AS valid_from, lead(since) OVER (PARTITION BY custkey ORDER BY since, tie) AS valid_to, tie FROM s),
three AS (SELECT custkey, arg_max(priority, (since, tie)) AS priority, max_by(before, (since, tie)) AS previous FROM s GROUP BY custkey)
SELECT 'type2' AS kind, custkey, priority, valid_from, valid_to, NULL AS previous FROM two
UNION ALL SELECT 'type1', custkey, priority, NULL, NULL, NULL FROM three
UNION ALL SELECT 'type3', custkey, priority, NULL, NULL, previous FROM three""")
def merge_scd(spark, sf, **sizing):
    """Type 2 keeps every stretch, type 1 the latest value, type 3 the latest and the one before it.

    The dimension is stored; a second delivery, of changes from all through the same time, is merged into it.
    """
    changes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("tie"),
    )
    late, names = F.crc32(F.col("tie").cast("string")) % 4 == 0, ("custkey", "priority", "at", "tie")
    stored = VersionedTable(
        spark, scratch(spark, "dimension"),
        "custkey bigint, priority string, at timestamp_ntz, tie bigint, starts boolean, valid_to timestamp_ntz", ["custkey"],
        bucket_count(total_bytes(spark, f"{sf}/orders.parquet"), least=4))
    stored.create(observed(changes.filter(~late), *names, **sizing))
    merge_history(stored, changes.filter(late), *names, **sizing)
    stretches = land(stretches_of(stored.read(), "custkey", "priority", "at"), "history")
    current = stretches.filter("is_current")
    ended = stretches.filter("not is_current").groupBy("custkey").agg(
        F.max_by("priority", F.struct("valid_to", "valid_from")).alias("previous")
    )
    columns = ["kind", "custkey", "priority", "valid_from", "valid_to", "previous"]
    none = F.lit(None)
    two = stretches.select(F.lit("type2").alias("kind"), "custkey", "priority", "valid_from", "valid_to",
                           none.cast("string").alias("previous"))
    empty = [none.cast("timestamp_ntz").alias(c) for c in ("valid_from", "valid_to")]
    one = current.select(F.lit("type1").alias("kind"), "custkey", "priority", *empty, none.cast("string").alias("previous"))
    three = current.join(ended, "custkey", "left").select(
        F.lit("type3").alias("kind"), "custkey", "priority", *empty, "previous"
    )
    return two.unionByName(one).unionByName(three).select(*columns)


@query("cdc_apply", """
WITH f AS (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events)
SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM f
GROUP BY user_id HAVING arg_max(op, event_id) <> 'd'""")
def cdc_apply(spark, sf):
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    feed = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", op.alias("op"))
    return apply_changes(feed, "user_id", "event_id", ["event_type", "value"])


def closed(frame, kind):
    times = [F.col(f"w.{edge}").cast("timestamp_ntz").alias(f"window_{edge}") for edge in ("start", "end")]
    return frame.select(F.lit(kind).alias("kind"), *times, "who", "n", F.round("total", 2).alias("total"))


@query("tumbling_sliding_session", """
WITH tum AS (SELECT 'tumbling' AS kind, time_bucket(INTERVAL 6 HOUR, ts) AS s, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS e, event_type AS who,
  count(*) AS n, sum(value) AS total FROM events GROUP BY ALL),
sli AS (SELECT 'sliding' AS kind, s, s + INTERVAL 12 HOUR AS e, event_type AS who, count(*) AS n, sum(value) AS total FROM (
  SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY ALL),
gap AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS starts FROM events),
ses0 AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM gap),
ses AS (SELECT 'session' AS kind, min(ts) AS s, max(ts) + INTERVAL 2 HOUR AS e, CAST(user_id AS VARCHAR) AS who, count(*) AS n, sum(value) AS total
  FROM ses0 GROUP BY user_id, no)
SELECT kind, s AS window_start, e AS window_end, who, n, round(total, 2) AS total
FROM (SELECT * FROM tum UNION ALL SELECT * FROM sli UNION ALL SELECT * FROM ses)""")
def tumbling_sliding_session(spark, sf):
    """Tumbling and sliding windows in update mode: every batch emits the windows it changed, the last one wins.

    Sessions know append mode only, which emits a session once the watermark has passed it. A closing mark, an event of nobody
    two days after the last, brings the watermark past all of them.
    """
    events, marks = table(spark, sf, "events"), scratch(spark, "marks")
    events.limit(0).write.parquet(marks)
    stream = eventtime.timed(ingest.stream_table(spark, sf, "events"), "1 hour")
    kinds = [F.col("event_type").alias("who")]
    grouped = {"tumbling": eventtime.tumbling(stream, kinds, "6 hours"),
               "sliding": eventtime.sliding(stream, kinds, "12 hours", "6 hours")}
    shape, parts = ["kind", "window_start", "window_end", "who"], []
    for kind, frame in grouped.items():
        path = scratch(spark, kind)
        eventtime.land_updates(closed(frame.agg(F.count("*").alias("n"), F.sum("value").alias("total")), kind), path,
                               scratch(spark, f"{kind}-checkpoint"))
        parts.append(eventtime.newest(spark.read.parquet(path), shape, ["n", "total"]))

    path, checkpoint = scratch(spark, "sessions"), scratch(spark, "sessions-checkpoint")
    for _ in range(2):
        both = ingest.stream_table(spark, sf, "events").unionByName(ingest.stream_files(spark, marks, events.schema))
        frame = eventtime.sessions(eventtime.timed(both, "1 hour"), [F.col("user_id").cast("string").alias("who")], "2 hours")
        totals = frame.agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        ingest.land(closed(totals, "session"), path, checkpoint)
        last = events.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
        last.select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
                    ).write.mode("append").parquet(marks)
    parts.append(spark.read.parquet(path).filter("who IS NOT NULL"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("late_data_drop", """
WITH mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS seen_to FROM events)
SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n FROM events, mark WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'
GROUP BY day, seen_to HAVING time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= seen_to""")
def late_data_drop(spark, sf):
    """The later half arrives first; the earlier half is then behind the watermark and is dropped."""
    events, source = table(spark, sf, "events"), scratch(spark, "late")
    noon = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    out, checkpoint = scratch(spark, "late-out"), scratch(spark, "late-checkpoint")
    for half in (events.filter(F.col("ts") >= noon), events.filter(F.col("ts") < noon)):
        half.write.mode("append").parquet(source)
        stream = eventtime.timed(ingest.stream_files(spark, source, events.schema), "1 hour")
        days = eventtime.tumbling(stream, [], "1 day").agg(F.count("*").alias("n"))
        ingest.land(days.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "n"), out, checkpoint)
    return spark.read.parquet(out)


@query("stream_joins", """
SELECT 'static' AS kind, event_id, c_custkey AS other FROM events JOIN customer ON user_id = c_custkey
UNION ALL SELECT 'interval', a.event_id, b.event_id FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR""")
def stream_joins(spark, sf):
    events = ingest.stream_table(spark, sf, "events")
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    static = events.join(people, "user_id").select("event_id", F.col("user_id").alias("other"))

    def side(kind, prefix):
        return eventtime.timed(ingest.stream_table(spark, sf, "events"), "1 hour").filter(
            F.col("event_type") == kind
        ).select(F.col("user_id").alias("user_id"), F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))

    clicks, buys = side("click", "click"), side("purchase", "buy")
    pairs = eventtime.within(clicks, buys, "user_id", "click_ts", "buy_ts", 6 * 3600).select(
        F.col("click_id").alias("event_id"), F.col("buy_id").alias("other")
    )
    parts = []
    for kind, stream in (("static", static), ("interval", pairs)):
        path = scratch(spark, kind)
        ingest.land(stream, path, scratch(spark, f"{kind}-checkpoint"))
        parts.append(spark.read.parquet(path).select(F.lit(kind).alias("kind"), "event_id", "other"))
    return parts[0].unionByName(parts[1])


@query("stateful_per_key", """
SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id""")
def stateful_per_key(spark, sf):
    """Two deliveries; the state carries over and the last update of every key is its running total."""
    source, out, checkpoint = (scratch(spark, f"state-{part}") for part in ("in", "out", "checkpoint"))
    events = table(spark, sf, "events")
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        stream = ingest.stream_files(spark, source, events.schema).select("user_id", "value")
        eventtime.land_updates(eventtime.running_totals(stream, "user_id", "value"), out, checkpoint)
    updates = spark.read.parquet(out)
    last = updates.groupBy("user_id").agg(F.max_by(F.struct("n", "total"), "n").alias("s"))
    return last.select("user_id", "s.n", F.round("s.total", 2).alias("total"))


@query("quiet_spells", """
WITH gap AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 1 DAY THEN 0 ELSE 1 END AS starts FROM events),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM gap)
SELECT user_id, min(ts) AS start, max(ts) AS stop, count(*) AS n, round(sum(value), 2) AS total FROM numbered GROUP BY user_id, no""")
def quiet_spells(spark, sf):
    """Timers: a user's stretch of activity comes out when the user has been silent for a day.

    The events arrive in deliveries by time. A closing mark, an event of nobody four days after the last, lets the timers of the
    last stretches fire.
    """
    source, out, checkpoint = (scratch(spark, f"spells-{part}") for part in ("in", "out", "checkpoint"))
    events = table(spark, sf, "events").select("user_id", "ts", "value")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    mark = events.agg(F.lit(None).cast(events.schema["user_id"].dataType).alias("user_id"),
                      (F.max("ts") + F.expr("INTERVAL 4 DAYS")).alias("ts"), F.lit(0.0).alias("value"))
    for delivery in (events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle), mark):
        delivery.write.mode("append").parquet(source)
        stream = ingest.stream_files(spark, source, events.schema)
        ingest.land(eventtime.quiet_spells(stream, "user_id", "value", 24 * 3600, 3600), out, checkpoint)
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "stop")]
    return spark.read.parquet(out).filter("user_id IS NOT NULL").select("user_id", *times, "n", F.round("total", 2).alias("total"))


HASH = "md5({})"


@query("star_schema_build", f"""
SELECT {HASH.format("len(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey")} AS customer_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
  {HASH.format("len(c_mktsegment) || ':' || c_mktsegment || '|' || len(CAST(c_nationkey AS VARCHAR)) || ':' || c_nationkey")} AS segment_key, o_orderkey, o_totalprice,
  round(sum(o_totalprice) OVER (PARTITION BY c_mktsegment, c_nationkey, strftime(o_orderdate, '%Y%m')), 2) AS month_total
FROM orders JOIN customer ON o_custkey = c_custkey""")
def star_schema_build(spark, sf):
    """Dimensions under hash keys, a fact table of orders, and a monthly snapshot joined back for the report."""
    root = scratch(spark, "star")
    customer = table(spark, sf, "customer")
    segment_key = surrogate_key(F.col("c_mktsegment"), F.col("c_nationkey")).alias("segment_key")
    customer.select(
        surrogate_key(F.col("c_custkey")).alias("customer_key"), "c_custkey", "c_name", segment_key
    ).write.parquet(f"{root}/dim_customer")
    customer.select(segment_key, "c_mktsegment", "c_nationkey").distinct().write.parquet(f"{root}/dim_segment")
    orders = table(spark, sf, "orders")
    orders.select(
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"), F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    ).distinct().write.parquet(f"{root}/dim_date")
    keyed = spark.read.parquet(f"{root}/dim_customer").select("c_custkey", "customer_key", "segment_key")
    orders.select(
        F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
        "o_orderkey", "o_totalprice",
    ).join(keyed, "c_custkey").drop("c_custkey").write.parquet(f"{root}/fact_orders")
    fact = spark.read.parquet(f"{root}/fact_orders").withColumn("month_key", F.floor(F.col("date_key") / 100))
    snapshot = fact.groupBy("segment_key", "month_key").agg(F.round(F.sum("o_totalprice"), 2).alias("month_total"))
    snapshot.write.parquet(f"{root}/snapshot_month")
    monthly = spark.read.parquet(f"{root}/snapshot_month")
    return fact.join(monthly, ["segment_key", "month_key"]).drop("month_key")


@query("medallion_layers", """
WITH silver AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events WHERE value >= 1 AND event_type <> 'error')
SELECT day, event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 2) AS total FROM silver GROUP BY day, event_type""")
def medallion_layers(spark, sf):
    """Bronze keeps raw lines with their arrival, silver is typed, filtered and unique, gold is the daily report."""
    root = scratch(spark, "layers")
    raw = table(spark, sf, "events").select(F.to_json(F.struct("*")).alias("line"), F.current_timestamp().alias("arrived"))
    raw.unionByName(raw.filter(F.xxhash64("line") % 10 == 0)).write.parquet(f"{root}/bronze")  # some lines come twice
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double"
    rows = spark.read.parquet(f"{root}/bronze").select(F.from_json("line", schema).alias("r")).select("r.*")
    silver = rows.filter("value >= 1 AND event_type <> 'error'").dropDuplicates(["event_id"])
    silver.select("event_id", "user_id", "event_type", "value", F.to_date(F.substring("ts", 1, 10)).alias("day")).write.parquet(
        f"{root}/silver"
    )
    gold = spark.read.parquet(f"{root}/silver").groupBy("day", "event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total")
    )
    gold.write.parquet(f"{root}/gold")
    return spark.read.parquet(f"{root}/gold")


@query("dq_checks", """
SELECT 'not_null_price' AS check_name, count(*) AS n_rows, count(*) FILTER (WHERE o_totalprice IS NULL) AS failed FROM orders
UNION ALL SELECT 'accepted_status', count(*), count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'positive_price', count(*), count(*) FILTER (WHERE o_totalprice < 1000) FROM orders
UNION ALL SELECT 'unique_orderkey', count(*), count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'customer_exists', count(*), count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) FROM orders""")
def dq_checks(spark, sf):
    orders = table(spark, sf, "orders")
    report = quality_report(
        orders,
        {
            "not_null_price": F.col("o_totalprice").isNotNull(),
            "accepted_status": F.col("o_orderstatus").isin("F", "O"),
            "positive_price": F.col("o_totalprice") >= 1000,
        },
    )
    unique = duplicate_keys(orders, "o_orderkey").withColumn("check_name", F.lit("unique_orderkey"))
    parents = table(spark, sf, "customer").filter("c_acctbal >= 0")
    related = orphans(orders, "o_custkey", parents, "c_custkey").withColumn("check_name", F.lit("customer_exists"))
    return report.unionByName(unique).unionByName(related)


EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]"
PHONE = r"\+[0-9]+ \([0-9]{3}\) [0-9]{3}-[0-9]{4}"


#: The salt where the session sets none in spark.weftline.pii.salt: for tests only.
SALT = "pepper"


@query("pii_tokenize", rf"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{EMAIL}', '<email>', 'g'), '{PHONE}', '<phone>', 'g')) AS masked_digest,
  CAST(len(regexp_extract_all(text, '{EMAIL}')) AS INTEGER) AS emails, substr(sha256('{SALT}|' || source), 1, 16) AS source_token FROM documents""")
def pii_tokenize(spark, sf):
    """Addresses and numbers masked in the whole text; the source replaced by a token salted with the session's secret."""
    salt = spark.conf.get("spark.weftline.pii.salt", SALT)
    text = F.regexp_replace(F.regexp_replace("text", EMAIL, "<email>"), PHONE, "<phone>")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(text).alias("masked_digest"),
        F.size(F.regexp_extract_all("text", F.lit(EMAIL), F.lit(0))).alias("emails"),
        F.substring(F.sha2(F.concat(F.lit(f"{salt}|"), "source"), 256), 1, 16).alias("source_token"),
    )


@F.pandas_udf(DoubleType())
def log_scaled(value: pd.Series) -> pd.Series:
    return np.log1p(value)


@F.pandas_udf(DoubleType())
def squares(value: pd.Series) -> float:
    return float((value * value).sum())


def chunk_moments(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"event_type": batch["event_type"].iloc[:1], "n": [len(batch)], "total": [batch["value"].sum()]}
    )


@query("pandas_udf_forms", """
SELECT 'scalar' AS form, event_type, round(sum(ln(1 + value)), 4) AS result FROM events GROUP BY event_type
UNION ALL SELECT 'aggregate', event_type, round(sum(value * value), 4) FROM events GROUP BY event_type
UNION ALL SELECT 'map', event_type, round(avg(value), 6) FROM events GROUP BY event_type""")
def pandas_udf_forms(spark, sf, chunk: int = 100_000):
    """Grouped forms run on hashed chunks of a group, so no task loads a whole hot group; totals combine natively."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    scalar = events.groupBy("event_type").agg(F.round(F.sum(log_scaled("value")), 4).alias("result"))
    parts = max(1, -(-events.count() // chunk))
    chunks = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(parts)))
    partial = chunks.groupBy("event_type", "part").agg(squares("value").alias("s"))
    aggregate = partial.groupBy("event_type").agg(F.round(F.sum("s"), 4).alias("result"))
    moments = chunks.groupBy("event_type", "part").applyInPandas(chunk_moments, "event_type string, n long, total double")
    mapped = moments.groupBy("event_type").agg(F.round(F.sum("total") / F.sum("n"), 6).alias("result"))
    forms = {"scalar": scalar, "aggregate": aggregate, "map": mapped}
    parts = [f.select(F.lit(name).alias("form"), "event_type", "result") for name, f in forms.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ml_features")
def ml_features(spark, sf, clusters: int = 4):
    """Label index, scaled vectors and k-means over the embeddings."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, StringIndexer
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"),
    )
    stages = [
        StringIndexer(inputCol="label", outputCol="label_index"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=clusters, seed=7, featuresCol="features", predictionCol="cluster", maxIter=20),
    ]
    fitted = Pipeline(stages=stages).fit(rows)
    return fitted.transform(rows).groupBy("cluster", "label_index").agg(F.count("*").alias("n"))


@query("cogroup_datasets", """
WITH o1 AS (SELECT o_custkey AS k, o_orderkey AS id, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // %(n)d AS part FROM orders),
e1 AS (SELECT user_id AS k, event_id AS id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // %(n)d AS part FROM events),
o AS (SELECT k, part, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS orders FROM o1 GROUP BY k, part),
e AS (SELECT k, part, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS events FROM e1 GROUP BY k, part)
SELECT coalesce(o.k, e.k) AS k, CAST(coalesce(o.part, e.part) AS BIGINT) AS part, coalesce(orders, '') AS orders, coalesce(events, '') AS events
FROM o FULL JOIN e ON o.k = e.k AND o.part = e.part""" % {"n": CHUNK_ROWS})
def cogroup_datasets(spark, sf):
    """Per key the bag of each side. Long bags continue in further parts, so a hot key is many rows, not one."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"))
    events = table(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("id"))
    sides = {
        name: bags(frame, ["k"], [("id", False)], F.col("id").cast("string")).withColumnRenamed("bag", name)
        for name, frame in (("orders", orders), ("events", events))
    }
    both = sides["orders"].join(sides["events"], ["k", "part"], "full")
    texts = [F.coalesce(F.array_join(name, ","), F.lit("")).alias(name) for name in sides]
    return both.select("k", "part", *texts)


@query("incremental_rollup", """
SELECT CASE WHEN grouping(day) = 0 THEN day END AS day, event_type, count(*) AS n, round(sum(value), 2) AS total, min(value) AS low, max(value) AS high,
  CAST(grouping(day) + grouping(event_type) AS INTEGER) AS level
FROM (SELECT CAST(ts AS DATE) AS day, * FROM events) GROUP BY ROLLUP (event_type, day)""")
def incremental_rollup(spark, sf):
    """Every delivery stores its own partial totals; the report merges partials and rolls them up."""
    stored = scratch(spark, "partials")
    events = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), "event_type", "value")
    for batch in (0, 1, 2):
        part = events.filter(F.pmod("event_id", F.lit(3)) == batch)
        partial_totals(part, ["event_type", "day"], "value").write.mode("overwrite").parquet(f"{stored}/batch={batch}")
    merged = merge_totals(spark.read.parquet(stored), ["event_type", "day"])
    return rollup_totals(merged, ["event_type", "day"]).withColumn("total", F.round("total", 2))


@query("approx_distinct_sketch")
def approx_distinct_sketch(spark, sf):
    """Daily sketches of distinct users, merged into one estimate per event type."""
    events = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    return merge_sketches(distinct_sketches(events, ["event_type", "day"], "user_id"), ["event_type"])
