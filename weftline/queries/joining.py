"""Joins and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import DEPARTMENTS, DEPT, EMP, SALES, dept, emp, money_text, table
from weftline.functions.numbers import mean
from weftline.operators.joins import product_with_list, salted_join
from weftline.operators.ordered import attach_group
from weftline.plans.sizing import broadcast_if_small
from weftline.registry import query
from weftline.sources.files import split_fields


def own_unit():
    return F.col("department") == F.col("dept_name")


@query("inner_join", f"""
WITH {EMP}, {DEPT} SELECT name, salary, location FROM emp JOIN dept ON department = dept_name""")
def inner_join(spark, sf):
    return emp(spark, sf).join(dept(spark), own_unit()).select("name", "salary", "location")


@query("left_outer_join", f"""
WITH {EMP}, {DEPT} SELECT name, department, location FROM emp LEFT JOIN dept ON department = dept_name""")
def left_outer_join(spark, sf):
    return emp(spark, sf).join(dept(spark), own_unit(), "left").select("name", "department", "location")


@query("right_outer_join", f"""
WITH {EMP}, {DEPT} SELECT name, dept_name, location FROM emp RIGHT JOIN dept ON department = dept_name""")
def right_outer_join(spark, sf):
    return emp(spark, sf).join(dept(spark), own_unit(), "right").select("name", "dept_name", "location")


@query("full_outer_join", f"""
WITH {EMP}, {DEPT} SELECT name, dept_name, location FROM emp FULL JOIN dept ON department = dept_name""")
def full_outer_join(spark, sf):
    """A full outer join cannot broadcast and would send each department to one task.

    The left outer join keeps every employee without moving one; the departments nobody matched are added from an anti
    join against the distinct department names.
    """
    staff, units = emp(spark, sf), dept(spark)
    kept = staff.join(units, own_unit(), "left").select("name", "dept_name", "location")
    used = staff.select("department").distinct()
    alone = units.join(used, own_unit(), "left_anti").select(
        F.lit(None).cast("string").alias("name"), "dept_name", "location"
    )
    return kept.unionByName(alone)


@query("cross_join", f"""
WITH {EMP}, {DEPT} SELECT emp_id, name, dept_name FROM emp CROSS JOIN dept ORDER BY emp_id, dept_name LIMIT 20""")
def cross_join(spark, sf):
    paired = product_with_list(emp(spark, sf).select("emp_id", "name"), "dept_name", [d[0] for d in DEPARTMENTS])
    return paired.orderBy("emp_id", "dept_name").limit(20)


@query("left_semi_join", f"""
WITH {EMP}, {DEPT} SELECT name, salary FROM emp WHERE department IN (SELECT dept_name FROM dept)""")
def left_semi_join(spark, sf):
    return emp(spark, sf).join(dept(spark), own_unit(), "left_semi").select("name", "salary")


@query("broadcast_join", f"""
WITH {EMP}, {DEPT} SELECT emp_id, name, salary, division, location FROM emp JOIN dept ON department = dept_name""")
def broadcast_join(spark, sf):
    units = broadcast_if_small(dept(spark))
    return emp(spark, sf).join(units, own_unit()).select("emp_id", "name", "salary", "division", "location")


@query("map_side_left_lookup", f"""
WITH {EMP}, {DEPT} SELECT emp_id, name, salary, coalesce(dept_name, 'NULL') AS dept_name,
  CASE WHEN dept_name IS NULL THEN 'NULL' ELSE coalesce(nullif(location, 'Oslo'), 'Unknown') END AS location
FROM emp LEFT JOIN dept ON department = dept_name WHERE emp_id % 97 <> 5""")
def map_side_left_lookup(spark, sf):
    """Delimited lines looked up in a small table; some lines break off after two fields and are dropped.

    No match gives the text NULL, a match without a location gives Unknown.
    """
    whole = F.concat_ws(",", "emp_id", "name", "department", money_text("salary"))
    broken = F.concat_ws(",", "emp_id", "name")
    line = F.when(F.col("emp_id") % 97 == 5, broken).otherwise(whole)
    staff = split_fields(
        emp(spark, sf).select(line.alias("value")), ["emp_id", "name", "department", "salary"], at_least=3
    )
    units = dept(spark).withColumn("location", F.nullif(F.col("location"), F.lit("Oslo")))
    found = F.col("dept_name").isNotNull()
    return staff.join(broadcast_if_small(units), own_unit(), "left").select(
        F.col("emp_id").cast("bigint").alias("emp_id"),
        "name",
        F.col("salary").cast("double").alias("salary"),
        F.coalesce("dept_name", F.lit("NULL")).alias("dept_name"),
        F.when(found, F.coalesce("location", F.lit("Unknown"))).otherwise("NULL").alias("location"),
    )


@query("reduce_side_join", """
SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def reduce_side_join(spark, sf):
    """Both inputs are shuffled on the key and merged; adaptive execution splits a skewed key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("multi_way_join", f"""
WITH {EMP}, {DEPT}, {SALES} SELECT e.name, e.salary, d.location, s.sale_id, s.amount
FROM sales s JOIN orders o ON s.sale_id = o.o_orderkey JOIN emp e ON o.o_custkey = e.emp_id
JOIN dept d ON e.department = d.dept_name
WHERE s.year = 1997 AND s.quarter = 'Q1' ORDER BY s.amount DESC, s.sale_id LIMIT 10""")
def multi_way_join(spark, sf):
    when = (F.year("o_orderdate") == 1997) & (F.quarter("o_orderdate") == 1)
    sold = table(spark, sf, "orders").filter(when).select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("emp_id"), F.col("o_totalprice").alias("amount")
    )
    return (
        sold.join(emp(spark, sf), "emp_id")
        .join(dept(spark), own_unit())
        .select("name", "salary", "location", "sale_id", "amount")
        .orderBy(F.desc("amount"), "sale_id")
        .limit(10)
    )


@query("join_to_group_average", f"""
WITH {EMP}, a AS (SELECT department, avg(CAST(salary AS DECIMAL(28,10))) AS avg_sal FROM emp GROUP BY department)
SELECT emp.name, emp.department, emp.salary, round(a.avg_sal, 4) AS avg_sal FROM emp JOIN a USING (department)
WHERE emp.salary > a.avg_sal ORDER BY emp.department, emp.salary DESC""")
def join_to_group_average(spark, sf):
    staff = attach_group(
        emp(spark, sf).select("name", "department", "salary"), ["department"], {"avg_sal": mean("salary")}
    )
    return (
        staff.filter("salary > avg_sal")
        .withColumn("avg_sal", F.round("avg_sal", 4))
        .orderBy("department", F.desc("salary"), "name")
    )


@query("scalar_subquery", f"""
WITH {EMP} SELECT name, salary, department FROM emp WHERE salary > (SELECT avg(salary) FROM emp)
ORDER BY salary DESC, name""")
def scalar_subquery(spark, sf):
    emp(spark, sf).createOrReplaceTempView("weft_sub_emp")
    return spark.sql("""
        SELECT name, salary, department FROM weft_sub_emp
        WHERE salary > (SELECT avg(salary) FROM weft_sub_emp) ORDER BY salary DESC, name""")


@query("skew_join", """
SELECT e.event_id, e.user_id, e.event_type, t.first_event, t.type_rows FROM events e JOIN
  (SELECT event_type, min(event_id) AS first_event, count(*) AS type_rows FROM events GROUP BY event_type) t
  ON e.event_type = t.event_type""")
def skew_join(spark, sf):
    """Five event types hold all rows, so every type is hot and its events are spread by salts."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    types = events.groupBy("event_type").agg(F.min("event_id").alias("first_event"), F.count("*").alias("type_rows"))
    return salted_join(events, types, "event_type", "event_id").select(
        "event_id", "user_id", "event_type", "first_event", "type_rows")


@query("filtered_dimension_join", f"""
WITH {EMP}, {DEPT} SELECT name, salary, location FROM emp JOIN dept ON department = dept_name WHERE division = 'Home'""")
def filtered_dimension_join(spark, sf):
    return emp(spark, sf).join(dept(spark).filter("division = 'Home'"), own_unit()).select("name", "salary", "location")
