"""Versioned-cell jobs over the events, one row per user and one cell per event type; and the employees as cells."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.adapters import CELLS, DEPT, EMP, WIDE, cells, dept, emp, money_text, table
from weftline.functions.numbers import mean
from weftline.operators import cells as hb
from weftline.plans.sizing import broadcast_if_small
from weftline.registry import query
from weftline.session import scratch
from weftline.streaming import ingest

LATEST = f"""{CELLS}, latest AS (SELECT row_key, family, qualifier, version_ts, seq, value FROM (SELECT *, row_number() OVER
  (PARTITION BY row_key, family, qualifier ORDER BY version_ts DESC, seq DESC) AS rn FROM cells) WHERE rn = 1)"""
SHOWN = ["row_key", "qualifier", "value"]
USER_7, USER_9, USER_20 = (f"user:{n:010d}" for n in (7, 9, 20))
MAPPING = {
    "name": ("personal", "name"), "country": ("personal", "country"), "department": ("work", "department"),
    "salary": ("work", "salary"),
}


def amount(column="value"):
    return F.col(column).cast("decimal(18,2)")


@query("cells_put_latest", f"WITH {LATEST} SELECT row_key, family, qualifier, version_ts, value FROM latest")
def cells_put_latest(spark, sf):
    return hb.latest(cells(spark, sf)).drop("seq")


@query("get_row", f"""
WITH {LATEST} SELECT 'all' AS request, row_key, qualifier, value FROM latest WHERE row_key = '{USER_7}'
UNION ALL SELECT 'family', row_key, qualifier, value FROM latest WHERE row_key = '{USER_7}' AND family = 'cf'
UNION ALL SELECT 'column', row_key, qualifier, value FROM latest WHERE row_key = '{USER_7}' AND qualifier = 'click'""")
def get_row(spark, sf):
    row = hb.get_rows(cells(spark, sf), [USER_7])
    requests = F.array_compact(F.array(
        F.lit("all"), F.when(F.col("family") == "cf", "family"), F.when(F.col("qualifier") == "click", "column")
    ))
    return row.select(F.explode(requests).alias("request"), *SHOWN)


@query("get_versions", f"""
WITH {CELLS} SELECT row_key, qualifier, value, version_ts, CAST(rn AS INTEGER) AS version_no FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version_ts DESC, seq DESC) AS rn FROM cells)
WHERE rn <= 3""")
def get_versions(spark, sf):
    return hb.versions(cells(spark, sf), 3).select(*SHOWN, "version_ts", "version_no")


@query("multi_get", f"""
WITH {LATEST} SELECT row_key, qualifier, value FROM latest WHERE row_key IN
  (SELECT printf('user:%010d', c_custkey) FROM customer WHERE c_acctbal > 9000)""")
def multi_get(spark, sf):
    wanted = emp(spark, sf).filter("salary > 9000").select(F.format_string("user:%010d", "emp_id").alias("row_key"))
    return hb.get_many(cells(spark, sf), wanted).select(*SHOWN)


@query("scan_all_limit", f"""
WITH {LATEST} SELECT row_key, qualifier, value FROM latest WHERE row_key IN
  (SELECT DISTINCT row_key FROM cells ORDER BY row_key LIMIT 2)""")
def scan_all_limit(spark, sf):
    return hb.first_rows(cells(spark, sf), 2).select(*SHOWN)


@query("scan_range", f"""
WITH {LATEST} SELECT row_key, qualifier, value FROM latest WHERE row_key >= '{USER_9}' AND row_key < '{USER_20}'""")
def scan_range(spark, sf):
    return hb.latest(hb.key_range(cells(spark, sf), USER_9, USER_20)).select(*SHOWN)


@query("scan_prefix", f"WITH {LATEST} SELECT row_key, qualifier, value FROM latest WHERE row_key LIKE 'user:00000000%'")
def scan_prefix(spark, sf):
    return hb.latest(cells(spark, sf).filter(F.col("row_key").startswith("user:00000000"))).select(*SHOWN)


@query("scan_columns", f"""
WITH {LATEST} SELECT row_key, max(value) FILTER (WHERE qualifier = 'click') AS click,
  max(value) FILTER (WHERE qualifier = 'purchase') AS purchase
FROM latest WHERE qualifier IN ('click', 'purchase') GROUP BY row_key""")
def scan_columns(spark, sf):
    return hb.to_wide(cells(spark, sf), {"click": ("cf", "click"), "purchase": ("cf", "purchase")})


@query("filter_value", f"""
WITH {LATEST} SELECT row_key, qualifier, value, value = '6.55' AS exact FROM latest WHERE value = '6.55' OR contains(value, '7.7')""")
def filter_value(spark, sf):
    hit = (F.col("value") == "6.55") | F.contains("value", F.lit("7.7"))
    return hb.latest(cells(spark, sf)).filter(hit).select(*SHOWN, (F.col("value") == "6.55").alias("exact"))


SCV = f"""{LATEST}, named AS (SELECT row_key, value,
  CASE WHEN qualifier = 'view' AND CAST(value AS DOUBLE) >= 60 THEN 'long_view' ELSE qualifier END AS qualifier FROM latest),
flags AS (SELECT row_key,
  max(CAST(value AS DOUBLE)) FILTER (WHERE qualifier = 'purchase') AS p, max(CAST(value AS DOUBLE)) FILTER (WHERE qualifier = 'view') AS v
  FROM named GROUP BY row_key)"""


def named_views(spark, sf):
    """Bigger views under a qualifier of their own: some rows then lack the column ``view``. Every cell stays."""
    now = hb.latest(cells(spark, sf))
    long = (F.col("qualifier") == "view") & (amount() >= 60)
    return now.withColumn("qualifier", F.when(long, "long_view").otherwise(F.col("qualifier")))


@query("filter_single_column", f"""
WITH {SCV} SELECT 'keep' AS missing, row_key, qualifier, value FROM named JOIN flags USING (row_key) WHERE v < 20 OR v IS NULL
UNION ALL SELECT 'drop', row_key, qualifier, value FROM named JOIN flags USING (row_key) WHERE v < 20""")
def filter_single_column(spark, sf):
    rows = named_views(spark, sf)
    test = {("cf", "view"): amount() < 20}
    kept = hb.rows_matching(rows, test).select(F.lit("keep").alias("missing"), *SHOWN)
    strict = hb.rows_matching(rows, test, filter_if_missing=True).select(F.lit("drop").alias("missing"), *SHOWN)
    return kept.unionByName(strict)


@query("filter_row_regex", f"WITH {LATEST} SELECT row_key, qualifier, value FROM latest WHERE regexp_matches(row_key, '00[12]$')")
def filter_row_regex(spark, sf):
    return hb.latest(cells(spark, sf).filter(F.col("row_key").rlike("00[12]$"))).select(*SHOWN)


@query("filter_qualifier_family", f"""
WITH {LATEST} SELECT row_key, qualifier, value FROM latest WHERE qualifier = 'purchase' AND family = 'cf'""")
def filter_qualifier_family(spark, sf):
    return hb.latest(cells(spark, sf).filter("qualifier = 'purchase' AND family = 'cf'")).select(*SHOWN)


@query("filter_list", f"""
WITH {SCV}, f AS (SELECT row_key, coalesce(p >= 30, true) AS a, coalesce(v < 20, true) AS b FROM flags)
SELECT 'and' AS mode, row_key, qualifier, value FROM named JOIN f USING (row_key) WHERE a AND b
UNION ALL SELECT 'or', row_key, qualifier, value FROM named JOIN f USING (row_key) WHERE a OR b""")
def filter_list(spark, sf):
    rows = named_views(spark, sf)
    tests = {("cf", "purchase"): amount() >= 30, ("cf", "view"): amount() < 20}
    parts = [hb.rows_matching(rows, tests, mode).select(F.lit(mode).alias("mode"), *SHOWN) for mode in ("and", "or")]
    return parts[0].unionByName(parts[1])


@query("column_pagination", f"""
WITH {LATEST} SELECT row_key, qualifier, value FROM (SELECT *, row_number() OVER
  (PARTITION BY row_key ORDER BY family, qualifier) AS rn FROM latest) WHERE rn > 1 AND rn <= 3""")
def column_pagination(spark, sf):
    return hb.column_page(cells(spark, sf), 2, 1).select(*SHOWN)


def tombstone_log(spark, sf):
    """Errors above 40 delete the user's click column at their time, errors below 1 delete the whole row."""
    error = F.col("qualifier") == "error"
    op = F.when(error & (amount() > 40), "delete_column").when(error & (amount() < 1), "delete_row").otherwise("put")
    log = cells(spark, sf).withColumn("op", op)
    return log.withColumn("qualifier", F.when(F.col("op") == "delete_column", "click").otherwise(F.col("qualifier")))


@query("delete_tombstones", f"""
WITH {CELLS}, log AS (SELECT row_key, version_ts, seq, value, CASE WHEN qualifier = 'error' AND CAST(value AS DOUBLE) > 40 THEN 'delete_column'
    WHEN qualifier = 'error' AND CAST(value AS DOUBLE) < 1 THEN 'delete_row' ELSE 'put' END AS op,
  CASE WHEN qualifier = 'error' AND CAST(value AS DOUBLE) > 40 THEN 'click' ELSE qualifier END AS qualifier FROM cells),
gone_row AS (SELECT row_key, max(seq) AS s FROM log WHERE op = 'delete_row' GROUP BY row_key),
gone_col AS (SELECT row_key, qualifier, max(seq) AS s FROM log WHERE op = 'delete_column' GROUP BY ALL),
alive AS (SELECT p.* FROM log p LEFT JOIN gone_row r USING (row_key) LEFT JOIN gone_col c USING (row_key, qualifier)
  WHERE p.op = 'put' AND p.seq > coalesce(r.s, -1) AND p.seq > coalesce(c.s, -1))
SELECT row_key, qualifier, value FROM (SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY seq DESC) AS rn FROM alive)
WHERE rn = 1""")
def delete_tombstones(spark, sf):
    return hb.visible(tombstone_log(spark, sf)).select(*SHOWN)


@query("retention_ttl_versions", f"""
WITH {CELLS} SELECT row_key, qualifier, version_ts, value FROM (SELECT *, row_number() OVER
  (PARTITION BY row_key, family, qualifier ORDER BY version_ts DESC, seq DESC) AS rn FROM cells
  WHERE version_ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 864000 SECOND) WHERE rn <= 3""")
def retention_ttl_versions(spark, sf):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    kept = hb.retain(cells(spark, sf), {"cf": 3}, {"cf": 864_000}, as_of)
    return kept.select("row_key", "qualifier", "version_ts", "value")


@query("counter_increment", """
SELECT 'page:' || event_type AS row_key, 'c' AS family, 'views' AS qualifier,
  CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS counter FROM events GROUP BY event_type""")
def counter_increment(spark, sf):
    """Increments come as a stream into stored counters; the first batches are folded before the rest arrives."""
    events, source, checkpoint = table(spark, sf, "events"), scratch(spark, "hits"), scratch(spark, "hits-checkpoint")
    counters = hb.Counters(spark, scratch(spark, "counters"))
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        deltas = ingest.stream_files(spark, source, events.schema).select(
            F.concat(F.lit("page:"), "event_type").alias("row_key"), F.lit("c").alias("family"),
            F.lit("views").alias("qualifier"), F.get_json_object("props", "$.k").cast("long").alias("delta"),
        )
        ingest.drain(deltas.writeStream.foreachBatch(counters.add).option("checkpointLocation", checkpoint)
                     .trigger(availableNow=True).start())
        if half == 0:
            counters.fold(0)
    return counters.read()


def staff_cells(spark, sf):
    wide = emp(spark, sf).select(
        F.format_string("emp:%010d", "emp_id").alias("row_key"), "name", "country", "department",
        money_text("salary").alias("salary"),
    )
    return hb.to_cells(wide, "row_key", MAPPING)


@query("batch_put_bulk", f"WITH {EMP}, {WIDE} SELECT row_key, family, qualifier, value FROM emp_cells")
def batch_put_bulk(spark, sf):
    path = scratch(spark, "batch-put")
    staff_cells(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


@query("bulk_load_sorted", f"WITH {EMP}, {WIDE} SELECT row_key, family, qualifier, value FROM emp_cells")
def bulk_load_sorted(spark, sf):
    """Tab-separated rows to column-mapped cells to globally sorted files."""
    raw, out = scratch(spark, "bulk-tsv"), scratch(spark, "bulk-sorted")
    emp(spark, sf).select(
        F.format_string("emp:%010d", "emp_id"), "name", "department", money_text("salary"), "country"
    ).write.option("sep", "\t").csv(raw)
    schema = "row_key string, name string, department string, salary string, country string"
    loaded = spark.read.schema(schema).option("sep", "\t").csv(raw)
    return hb.publish_sorted(hb.to_cells(loaded, "row_key", MAPPING), out)


def stamped(frame):
    return frame.withColumns({"version_ts": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "seq": F.lit(0)})


@query("wide_from_cells", f"""
WITH {EMP} SELECT department, count(*) AS headcount, round(avg(CAST(salary AS DECIMAL(28,10))), 4) AS avg_salary FROM emp
WHERE department <> 'FURNITURE' GROUP BY department""")
def wide_from_cells(spark, sf):
    wide = hb.to_wide(stamped(staff_cells(spark, sf)), MAPPING)
    return wide.filter("department <> 'FURNITURE'").groupBy("department").agg(
        F.count("*").alias("headcount"), F.round(mean("salary"), 4).alias("avg_salary")
    )


@query("cells_from_wide", f"""
WITH {EMP}, {WIDE} SELECT row_key, family, qualifier, value FROM emp_cells
WHERE NOT (qualifier = 'salary' AND value LIKE '-%')""")
def cells_from_wide(spark, sf):
    wide = emp(spark, sf).select(
        F.format_string("emp:%010d", "emp_id").alias("row_key"), "name", "country", "department",
        F.when(F.col("salary") >= 0, money_text("salary")).alias("salary"),
    )
    return hb.to_cells(wide, "row_key", MAPPING)


@query("key_salting", """
SELECT event_id, CAST(CAST('0x' || substr(md5(k), 1, 8) AS BIGINT) % 4 AS VARCHAR) || '_' || k AS salted FROM
  (SELECT event_id, strftime(ts, '%Y%m%d') || '_event' || CAST(event_id AS VARCHAR) AS k FROM events)""")
def key_salting(spark, sf):
    key = F.concat(F.date_format("version_ts", "yyyyMMdd"), F.lit("_event"), F.col("seq").cast("string"))
    return cells(spark, sf).select(F.col("seq").alias("event_id"), hb.salted_key(key, 4).alias("salted"))


@query("key_hashing", f"WITH {CELLS} SELECT DISTINCT row_key, substr(md5(row_key), 1, 8) || '_' || row_key AS hashed FROM cells")
def key_hashing(spark, sf):
    keys = cells(spark, sf).select("row_key").distinct()
    return keys.select("row_key", hb.hashed_key(F.col("row_key")).alias("hashed"))


@query("key_reverse_timestamp", f"""
WITH {CELLS}, k AS (SELECT *, row_key || ':' || lpad(CAST(9223372036854775807 - epoch_us(version_ts) AS VARCHAR), 19, '0') AS event_key FROM cells)
SELECT row_key, event_key, qualifier FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY event_key, seq DESC) AS rn FROM k) WHERE rn <= 5""")
def key_reverse_timestamp(spark, sf, last: int = 5):
    """The newest five events of every user are the first five keys."""
    keyed = cells(spark, sf).withColumn("event_key", hb.newest_first_key(F.col("row_key"), F.col("version_ts")))
    keyed.createOrReplaceTempView("weft_reverse_keys")
    return spark.sql(f"""
        SELECT row_key, event_key, qualifier FROM (
          SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY event_key, seq DESC) AS rn FROM weft_reverse_keys)
        WHERE rn <= {last}""")


@query("key_composite", f"""
WITH {CELLS} SELECT row_key || ':' || strftime(version_ts, '%Y%m%d') || ':' || qualifier AS event_key, value FROM cells
WHERE row_key || ':' || strftime(version_ts, '%Y%m%d') || ':' || qualifier LIKE '{USER_7}:202401%'""")
def key_composite(spark, sf):
    key = F.concat_ws(":", "row_key", F.date_format("version_ts", "yyyyMMdd"), "qualifier")
    keyed = cells(spark, sf).select(key.alias("event_key"), "value", "row_key")
    # the fixed-width user part of the prefix is a column of its own, so it prunes before the key is built
    return keyed.filter((F.col("row_key") == USER_7) & F.col("event_key").startswith(f"{USER_7}:202401")).drop("row_key")


@query("presplit_regions", """
WITH k AS (SELECT substr(md5(printf('user:%010d', user_id)), 1, 8) AS h FROM events),
r AS (SELECT CASE WHEN h < '4' THEN 0 WHEN h < '8' THEN 1 WHEN h < 'c' THEN 2 ELSE 3 END AS region, count(*) AS n FROM k GROUP BY 1)
SELECT CAST(region AS INTEGER) AS region, n, round(n / (sum(n) OVER () / count(*) OVER ()), 6) AS load FROM r""")
def presplit_regions(spark, sf):
    """Rows per region for fixed split points of the hashed key, and each region's load against the mean."""
    counts = (
        cells(spark, sf)
        .groupBy(hb.region_of(F.substring(F.md5("row_key"), 1, 8), ["4", "8", "c"]).alias("region"))
        .agg(F.count("*").alias("n"))
    )
    mean = F.avg("n").over(W.partitionBy(F.lit(0)))  # one row per region: four rows
    return counts.select("region", "n", F.round(F.col("n") / mean, 6).alias("load"))


@query("secondary_index", f"WITH {EMP} SELECT salary, name, department FROM emp WHERE salary > 9000")
def secondary_index(spark, sf):
    """A covering index: range-partitioned and sorted by salary, so file statistics skip everything below the bound."""
    path = scratch(spark, "index")
    index = emp(spark, sf).select("salary", "name", "department", "emp_id")
    index.repartitionByRange(F.desc("salary"), "emp_id").sortWithinPartitions(F.desc("salary"), "emp_id").write.parquet(path)
    return spark.read.parquet(path).filter("salary > 9000").select("salary", "name", "department")


@query("phoenix_queries", f"""
WITH {EMP}, {DEPT} SELECT 'filter' AS part, department, name, salary, CAST(NULL AS VARCHAR) AS location FROM emp WHERE department = 'BUILDING'
UNION ALL SELECT 'average', department, NULL, round(avg(CAST(salary AS DECIMAL(28,10))), 4), NULL FROM emp GROUP BY department
UNION ALL SELECT 'join', department, name, salary, location FROM emp JOIN dept ON department = dept_name WHERE salary > 8000""")
def typed_table_queries(spark, sf):
    staff = emp(spark, sf)
    none = F.lit(None).cast("string")
    filtered = staff.filter("department = 'BUILDING'").select(
        F.lit("filter").alias("part"), "department", "name", "salary", none.alias("location")
    )
    means = staff.groupBy("department").agg(F.round(mean("salary"), 4).alias("salary")).select(
        F.lit("average").alias("part"), "department", none.alias("name"), "salary", none.alias("location")
    )
    joined = staff.filter("salary > 8000").join(
        broadcast_if_small(dept(spark)), F.col("department") == F.col("dept_name")
    ).select(F.lit("join").alias("part"), "department", "name", "salary", "location")
    return filtered.unionByName(means).unionByName(joined)
