"""Sorts, limits, samples, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, emp, table
from weftline.operators.selection import route, sample_bucket, sample_bytes
from weftline.registry import query


@query("global_sort", f"WITH {EMP} SELECT emp_id, name, salary FROM emp ORDER BY salary DESC, emp_id")
def global_sort(spark, sf):
    return emp(spark, sf).select("emp_id", "name", "salary").orderBy(F.desc("salary"), "emp_id")


@query("sort_limit_topk", f"WITH {EMP} SELECT emp_id, name, salary FROM emp ORDER BY salary DESC, emp_id LIMIT 3")
def sort_limit_topk(spark, sf):
    return emp(spark, sf).select("emp_id", "name", "salary").orderBy(F.desc("salary"), "emp_id").limit(3)


@query("cluster_by", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def cluster_by(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("weft_cluster_orders")
    return spark.sql("SELECT o_custkey, o_orderkey, o_totalprice FROM weft_cluster_orders CLUSTER BY o_custkey")


@query("secondary_key_sort", f"""
WITH {EMP} SELECT department, name, salary FROM emp ORDER BY department, salary DESC, name""")
def secondary_key_sort(spark, sf):
    return emp(spark, sf).select("department", "name", "salary").orderBy("department", F.desc("salary"), "name")


@query("sample_percent")
def sample_percent(spark, sf):
    return table(spark, sf, "lineitem").sample(0.5, seed=11).select("l_orderkey", "l_linenumber", "l_quantity")


@query("sample_rows", f"WITH {EMP} SELECT emp_id, name, salary FROM emp ORDER BY emp_id LIMIT 10")
def sample_rows(spark, sf):
    return emp(spark, sf).select("emp_id", "name", "salary").orderBy("emp_id").limit(10)


@query("sample_bucket", f"WITH {EMP} SELECT emp_id, name FROM emp WHERE emp_id % 4 = 0")
def bucket_sample(spark, sf):
    return sample_bucket(emp(spark, sf).select("emp_id", "name"), "emp_id", 1, 4)


@query("sample_bytes", f"""
WITH {EMP}, sized AS (SELECT *, sum(strlen(CAST(emp_id AS VARCHAR)) + strlen(name) + strlen(department))
  OVER (ORDER BY emp_id ROWS UNBOUNDED PRECEDING) AS upto FROM emp)
SELECT emp_id, name, department FROM sized WHERE upto <= 1024""")
def bytes_sample(spark, sf):
    columns = ["emp_id", "name", "department"]
    return sample_bytes(emp(spark, sf).select(*columns), "emp_id", columns, 1024)


@query("union_all", f"""
WITH {EMP} SELECT emp_id, name, country FROM emp WHERE country = 'NATION_1' OR country = 'NATION_2'
UNION ALL SELECT emp_id, name, country FROM emp WHERE salary > 9000""")
def union_all(spark, sf):
    staff = emp(spark, sf).select("emp_id", "name", "country", "salary")
    near = staff.filter(F.col("country").isin("NATION_1", "NATION_2"))
    rich = staff.filter("salary > 9000")
    return near.unionByName(rich).drop("salary")


@query("split_relation", f"""
WITH {EMP} SELECT emp_id, salary, CASE WHEN salary >= 8000 THEN 'senior' WHEN salary >= 4000 THEN 'mid_level'
  ELSE 'junior' END AS branch FROM emp""")
def split_relation(spark, sf):
    pay = F.col("salary")
    return route(
        emp(spark, sf).select("emp_id", "salary"),
        {"senior": pay >= 8000, "mid_level": (pay >= 4000) & (pay < 8000)},
        otherwise="junior",
    )
