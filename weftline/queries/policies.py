"""Masking, row and column policies, round-trip checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, emp, table
from weftline.operators.governance import allowed_columns, fingerprint, last_four, rows_for
from weftline.registry import query
from weftline.session import scratch

# Which user sees which regions, and the column rules of the analyst role.
GRANTS = [("ana", "ASIA"), ("ana", "EUROPE"), ("bo", "AFRICA")]
ANALYST_RULES = [("allow", "*"), ("deny", "salary"), ("deny", "name")]


@query("column_mask", """
SELECT c_name, 'XXXX-XXXX-' || right(CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 4 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0')
  ELSE CAST(c_custkey AS VARCHAR) END, 4) AS account FROM customer""")
def column_mask(spark, sf):
    return table(spark, sf, "customer").select("c_name", last_four(F.col("c_custkey")).alias("account"))


@query("row_filter_policy", """
SELECT c_custkey, c_name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')""")
def row_filter_policy(spark, sf, user: str = "ana"):
    grants = ", ".join(f"('{u}', '{r}')" for u, r in GRANTS)
    policy = spark.sql(f"SELECT * FROM VALUES {grants} AS t(user, region)")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region")
    )
    # filter the few places first: the big table then meets only granted nations
    granted = rows_for(places, policy, user, "region")
    return table(spark, sf, "customer").join(granted, "c_nationkey").select("c_custkey", "c_name", "region")


@query("column_allow_list", f"WITH {EMP} SELECT emp_id, department, country FROM emp")
def column_allow_list(spark, sf):
    staff = emp(spark, sf)
    return staff.select(*allowed_columns(staff.columns, ANALYST_RULES))


@query("roundtrip_verify", """
SELECT count(*) AS written_rows, count(*) AS read_rows, true AS same_content FROM lineitem""")
def roundtrip_verify(spark, sf):
    source, path = table(spark, sf, "lineitem"), scratch(spark, "roundtrip")
    source.write.orc(path)
    sides = fingerprint(source).withColumn("side", F.lit("written")).unionByName(
        fingerprint(spark.read.schema(source.schema).orc(path)).withColumn("side", F.lit("read"))
    )
    return sides.agg(
        F.max(F.when(F.col("side") == "written", F.col("n_rows"))).alias("written_rows"),
        F.max(F.when(F.col("side") == "read", F.col("n_rows"))).alias("read_rows"),
        (F.min("content") == F.max("content")).alias("same_content"),
    )
