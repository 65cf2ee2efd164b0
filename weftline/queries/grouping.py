"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import CELLS, EMP, cells, emp, table
from weftline.functions.numbers import exact, mean
from weftline.functions.text import words_unicode
from weftline.operators.grouping import CHUNK_ROWS, bags, salted_sum
from weftline.plans.sizing import spread
from weftline.registry import query


def department_stats(frame):
    return (
        frame.groupBy("department")
        .agg(
            F.count("*").alias("headcount"),
            F.round(mean("salary"), 4).alias("avg_salary"),
            F.max("salary").alias("max_salary"),
            F.min("salary").alias("min_salary"),
            F.round(F.sum("salary"), 2).alias("total_salary"),
        )
        .orderBy(F.desc("avg_salary"), "department")
    )


@query("dept_stats", f"""
WITH {EMP} SELECT department, count(*) AS headcount, round(avg(CAST(salary AS DECIMAL(28,10))), 4) AS avg_salary, max(salary) AS max_salary,
  min(salary) AS min_salary, round(sum(salary), 2) AS total_salary
FROM emp GROUP BY department ORDER BY avg_salary DESC, department""")
def dept_stats(spark, sf):
    return department_stats(emp(spark, sf))


@query("having_filter", f"""
WITH {EMP} SELECT country, round(avg(CAST(salary AS DECIMAL(28,10))), 4) AS avg_sal FROM emp GROUP BY country HAVING avg(CAST(salary AS DECIMAL(28,10))) > 4500""")
def having_filter(spark, sf):
    means = emp(spark, sf).groupBy("country").agg(mean("salary").alias("avg_sal")).filter("avg_sal > 4500")
    return means.select("country", F.round("avg_sal", 4).alias("avg_sal"))


@query("global_count", "SELECT count(*) AS total FROM lineitem")
def global_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("total"))


@query("join_group_sum", """
SELECT c_custkey, c_name, round(sum(o_totalprice), 2) AS total_spend, count(*) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name""")
def join_group_sum(spark, sf):
    # total per key first: the join then sees one row per customer instead of one per order
    spend = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total_spend"), F.count("*").alias("n_orders"))
    )
    return table(spark, sf, "customer").select("c_custkey", "c_name").join(spend, "c_custkey")


def _orders_by_nation(spark, sf):
    """Orders with the nation of their customer; nation and region stay out until after the totals."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return orders.join(customer, "o_custkey")


def _region_of(spark, sf, totals):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return totals.join(nation, "c_nationkey").join(region, "n_regionkey")


@query("star_revenue", """
SELECT r_name AS region, p_type AS category, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
GROUP BY r_name, p_type""")
def star_revenue(spark, sf):
    price = exact("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", price.alias("price"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    placed = _orders_by_nation(spark, sf).select("o_orderkey", "c_nationkey")
    totals = (
        line.join(part, "l_partkey")
        .join(placed, "o_orderkey")
        .groupBy("c_nationkey", "category")
        .agg(F.sum("price").alias("price"))
    )
    return (
        _region_of(spark, sf, totals)
        .groupBy("region", "category")
        .agg(F.round(F.sum("price"), 2).cast("double").alias("revenue"))
    )


@query("region_order_totals", """
SELECT r_name AS region, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def region_order_totals(spark, sf):
    spend = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    )
    per_nation = (
        table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(spend, "c_custkey")
        .groupBy("c_nationkey").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    return (
        _region_of(spark, sf, per_nation)
        .groupBy("region")
        .agg(F.sum("n").alias("n_orders"), F.round(F.sum("s"), 2).alias("total"))
    )


@query("group_to_bag", f"""
WITH {EMP}, placed AS (
  SELECT *, (row_number() OVER (PARTITION BY department ORDER BY emp_id) - 1) // {CHUNK_ROWS} AS part FROM emp)
SELECT department, CAST(part AS BIGINT) AS part, count(*) AS members,
  string_agg(CAST(emp_id AS VARCHAR) || ':' || name, ',' ORDER BY emp_id) AS bag
FROM placed GROUP BY department, part""")
def group_to_bag(spark, sf):
    grouped = bags(
        emp(spark, sf).select("department", "emp_id", "name"),
        ["department"],
        [("emp_id", False)],
        F.struct("emp_id", "name"),
    )
    return grouped.select(
        "department",
        "part",
        F.size("bag").cast("long").alias("members"),
        F.array_join(
            F.transform("bag", lambda t: F.concat(t["emp_id"].cast("string"), F.lit(":"), t["name"])), ","
        ).alias("bag"),
    )


@query("agg_of_agg", r"""
WITH w AS (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents),
c AS (SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word)
SELECT CAST(sum(n) AS BIGINT) AS total_words, count(*) AS unique_words, max(n) AS top_count FROM c""")
def agg_of_agg(spark, sf):
    words = spread(table(spark, sf, "documents").select("text")).select(F.explode(words_unicode(F.col("text"))).alias("word"))
    counts = words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("total_words"), F.count("*").alias("unique_words"), F.max("n").alias("top_count")
    )


@query("combiner_sum", """
SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS n FROM lineitem GROUP BY l_partkey""")
def combiner_sum(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(F.sum("l_quantity").cast("long").alias("quantity"), F.count("*").alias("n"))
    )


@query("salted_aggregate", """
SELECT event_type, round(sum(value), 2) AS total, count(*) AS n_rows, min(value) AS low, max(value) AS high
FROM events GROUP BY event_type""")
def salted_aggregate(spark, sf):
    totals = salted_sum(table(spark, sf, "events"), ["event_type"], "event_id", "value")
    return totals.withColumn("total", F.round("total", 2))


@query("custom_partitioner_agg", """
SELECT o_orderpriority AS category, o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1, 2""")
def custom_partitioner_agg(spark, sf):
    # combine first, then choose which task gets each key; only one row per key and input task is moved
    partial = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("status"))
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    )
    return partial.repartitionByRange("category", "status").withColumn("total", F.round("total", 2))


@query("distinct_values", f"WITH {EMP} SELECT DISTINCT country FROM emp")
def distinct_values(spark, sf):
    return emp(spark, sf).select("country").distinct()


@query("dedup_by_key", """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dedup_by_key(spark, sf):
    first = F.min_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return (
        table(spark, sf, "events")
        .groupBy("user_id", "event_type")
        .agg(first.alias("kept"))
        .select("user_id", "event_type", "kept.event_id", "kept.value")
    )


@query("cell_group_count", f"""
WITH {CELLS}, latest AS (SELECT row_key, arg_max(value, (version_ts, seq)) FILTER (WHERE qualifier = 'signup') AS amount
  FROM cells GROUP BY row_key)
SELECT coalesce(CASE WHEN CAST(amount AS DOUBLE) >= 50 THEN 'high' WHEN CAST(amount AS DOUBLE) < 50 THEN 'low' END, 'Unknown') AS band,
  count(*) AS n FROM latest GROUP BY 1""")
def cell_group_count(spark, sf):
    amount = F.max_by("value", F.when(F.col("qualifier") == "signup", F.struct("version_ts", "seq")))
    latest = cells(spark, sf).groupBy("row_key").agg(amount.cast("double").alias("amount"))
    band = F.when(F.col("amount") >= 50, "high").when(F.col("amount") < 50, "low")
    return (
        latest.select(F.coalesce(band, F.lit("Unknown")).alias("band")).groupBy("band").agg(F.count("*").alias("n"))
    )
