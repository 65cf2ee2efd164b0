"""Views of the test tables under the names the jobs use, each with the matching SQL common table expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Department dimension. One segment is left out and one entry matches no segment,
# so outer joins show nulls on both sides.
DEPARTMENTS = [
    ("AUTOMOBILE", "Vehicles", "Detroit"),
    ("BUILDING", "Property", "Chicago"),
    ("FURNITURE", "Home", "Oslo"),
    ("HOUSEHOLD", "Home", "New York"),
    ("FINANCE", "Business", "New York"),
]

EMP = """emp AS (
  SELECT c_custkey AS emp_id, c_name AS name, c_mktsegment AS department, c_acctbal AS salary, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

EMP_H = (
    EMP
    + """,
emp_h AS (
  SELECT emp.*, hire_date FROM emp LEFT JOIN
    (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS hire_date FROM orders GROUP BY o_custkey) h
    ON emp_id = o_custkey)"""
)

DEPT = "dept(dept_name, division, location) AS (VALUES {})".format(
    ", ".join(f"('{n}', '{d}', '{w}')" for n, d, w in DEPARTMENTS)
)

SALES = """sales AS (
  SELECT o_orderkey AS sale_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
         o_orderpriority AS category, o_totalprice AS amount
  FROM orders)"""

CELLS = """cells AS (
  SELECT printf('user:%010d', user_id) AS row_key, 'cf' AS family, event_type AS qualifier,
         ts AS version_ts, event_id AS seq, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value
  FROM events)"""

WIDE = """emp_cells AS (
  SELECT printf('emp:%010d', emp_id) AS row_key, family, qualifier, value FROM emp,
  LATERAL (VALUES ('personal', 'name', name), ('personal', 'country', country), ('work', 'department', department),
    ('work', 'salary', CAST(CAST(salary AS DECIMAL(18,2)) AS VARCHAR))) v(family, qualifier, value))"""


def emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        F.col("c_acctbal").alias("salary"),
        F.col("n_name").alias("country"),
    )


def emp_hired(spark: SparkSession, sf_dir: str) -> DataFrame:
    hired = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("emp_id"))
        .agg(F.min(F.to_date("o_orderdate")).alias("hire_date"))
    )
    return emp(spark, sf_dir).join(hired, "emp_id", "left")


def dept(spark: SparkSession) -> DataFrame:
    """As SQL values: a local relation with a known size, so the planner broadcasts it by itself."""
    rows = ", ".join(f"('{n}', '{d}', '{w}')" for n, d, w in DEPARTMENTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(dept_name, division, location)")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("quarter"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amount"),
    )


def money_text(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.format_string("user:%010d", "user_id").alias("row_key"),
        F.lit("cf").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.col("ts").alias("version_ts"),
        F.col("event_id").alias("seq"),
        money_text("value").alias("value"),
    )
