"""Statistics and queries whose point is the plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, emp, table
from weftline.operators.tables import by_partition, fresh_database
from weftline.plans.stats import described, exact_distinct, merged, sketch_partitions
from weftline.registry import query
from weftline.session import land, tune

PROFILED = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


def profile_sql(part: str, distinct: str, grouped: str) -> str:
    return " UNION ALL ".join(f"""
SELECT {part} AS part, '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
  CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high, {distinct.format(c)} AS distinct_values FROM customer{grouped}"""
                              for c in PROFILED)


def sketched_customers(spark, sf):
    """Sketches of every nation's customers, stored like statistics of partitions, and the customers themselves."""
    name = f"{fresh_database(spark)}.customer"
    table(spark, sf, "customer").write.format("parquet").saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    rows = spark.table(name)
    return land(sketch_partitions(rows.select("c_nationkey", *PROFILED), "c_nationkey"), "sketches"), rows


@query("table_column_stats", profile_sql("CAST(NULL AS VARCHAR)", "count(DISTINCT {})", "") + " UNION ALL "
       + profile_sql("CAST(c_nationkey AS VARCHAR)", "CAST(NULL AS BIGINT)", " GROUP BY c_nationkey"))
def table_column_stats(spark, sf):
    """Rows of every partition and of the table, the latter merged from the stored rows of the partitions.

    The catalog's own statistics are gathered too. Exact distinct values are asked for the table; those of partitions are
    estimates, see `partition_sketches`.
    """
    parts, rows = sketched_customers(spark, sf)
    kept = ["part", "column_name", "n_rows", "nulls", "low", "high"]
    whole = described(merged(parts)).select(*kept).join(exact_distinct(rows.select(*PROFILED)), "column_name", "left")
    whole = whole.select(*kept, F.coalesce("distinct_values", F.lit(0)).cast("long").alias("distinct_values"))
    return whole.unionByName(described(parts).select(*kept, F.lit(None).cast("long").alias("distinct_values")))


@query("partition_sketches")
def partition_sketches(spark, sf):
    """Estimates by mergeable sketches, of every partition and of the table: distinct values, median, frequent values."""
    parts, _ = sketched_customers(spark, sf)
    shown = described(parts.unionByName(merged(parts)))
    return shown.withColumn("frequent", F.array_join(F.transform("frequent", lambda i: F.concat_ws(":", i["item"], i["count"])), ","))


@query("count_from_stats", """
SELECT count(*) AS n, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order, max(l_linenumber) AS lines FROM lineitem""")
def count_from_stats(spark, sf):
    """Answered from file footers: the second-version reader pushes the aggregate into the scan."""
    apart = tune(spark.newSession())  # the setting must not reach other queries of this session
    apart.conf.set("spark.sql.sources.useV1SourceList", "")
    lines = table(apart, sf, "lineitem")
    return lines.agg(
        F.count("*").alias("n"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"),
        F.max("l_linenumber").alias("lines"),
    )


@query("dynamic_partition_pruning", """
SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey = 2 GROUP BY n_name""")
def dynamic_partition_pruning(spark, sf):
    """Customers partitioned by nation; the filter on nation prunes their folders at run time."""
    name = f"{fresh_database(spark)}.customer_by_nation"
    by_partition(table(spark, sf, "customer"), "c_nationkey").write.partitionBy("c_nationkey").format(
        "parquet").saveAsTable(name)
    nation = table(spark, sf, "nation").filter("n_regionkey = 2")
    facts = spark.table(name)
    return facts.join(nation, facts.c_nationkey == nation.n_nationkey).groupBy("n_name").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")
    )


@query("cache_reuse", f"""
WITH {EMP}, paid AS (SELECT * FROM emp WHERE salary > 2000)
SELECT 'country' AS level, country AS name, count(*) AS n FROM paid GROUP BY country
UNION ALL SELECT 'department', department, count(*) FROM paid GROUP BY department""")
def cache_reuse(spark, sf):
    """One kept result feeds both branches; it holds the grouped counts, which are few, and not the rows. It lies in the shared
    scratch, so nothing stays in the memory of executors."""
    paid = emp(spark, sf).filter("salary > 2000").groupBy("country", "department").agg(F.count("*").alias("c"))
    paid = land(paid, "paid")
    parts = [
        paid.groupBy(F.lit(level).alias("level"), F.col(level).alias("name")).agg(F.sum("c").alias("n"))
        for level in ("country", "department")
    ]
    return parts[0].unionByName(parts[1])
