"""Window functions. Groups above the row bound are split over tasks, see operators.ordered."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, emp
from weftline.functions.numbers import mean, strict
from weftline.operators.ordered import attach_group, framed, needs_slices, ranked, running, value_range_mean
from weftline.plans.sizing import GROUP_ROWS
from weftline.registry import query

BY_PAY = [("salary", False), ("emp_id", False)]


def staff(spark, sf):
    return emp(spark, sf).select("emp_id", "name", "department", "salary")


@query("rank_family", f"""
WITH {EMP} SELECT emp_id, department, salary,
  row_number() OVER (PARTITION BY department ORDER BY salary DESC, emp_id) AS row_num,
  rank() OVER d AS rank_no, dense_rank() OVER d AS dense_rank_no, round(percent_rank() OVER d, 8) AS pct_rank
FROM emp WINDOW d AS (PARTITION BY department ORDER BY salary DESC)""")
def rank_family(spark, sf, **sizing):
    placed = ranked(staff(spark, sf), ["department"], "salary", "emp_id", descending=True, **sizing)
    return placed.select(
        "emp_id", "department", "salary", "row_num", "rank_no", "dense_rank_no", F.round("pct_rank", 8).alias("pct_rank")
    )


@query("top_n_per_group", f"""
WITH {EMP} SELECT department, name, salary FROM (
  SELECT *, row_number() OVER (PARTITION BY department ORDER BY salary DESC, emp_id) AS rn FROM emp) WHERE rn <= 2""")
def top_n_per_group(spark, sf, n: int = 2):
    """The rank filter is pushed below the shuffle (WindowGroupLimit): each task sends at most n rows per group."""
    staff(spark, sf).createOrReplaceTempView("weft_top_emp")
    return spark.sql(f"""
        SELECT department, name, salary FROM (
          SELECT *, row_number() OVER (PARTITION BY department ORDER BY salary DESC, emp_id) AS rn FROM weft_top_emp)
        WHERE rn <= {n}""")


@query("lag_lead", f"""
WITH {EMP} SELECT emp_id, salary, department,
  lag(salary, 1, 0) OVER (ORDER BY emp_id) AS prev_salary, lead(salary, 1, 0) OVER (ORDER BY emp_id) AS next_salary,
  round(salary - lag(salary, 1, salary) OVER (ORDER BY emp_id), 2) AS salary_diff,
  lag(salary) OVER (PARTITION BY department ORDER BY salary DESC, emp_id) AS better_paid
FROM emp""")
def lag_lead(spark, sf, group_rows=GROUP_ROWS):
    def neighbours(w):
        before = F.lag("salary").over(w)
        return {
            "prev_salary": F.coalesce(before, F.lit(0.0)),
            "next_salary": F.lead("salary", 1, 0.0).over(w),
            "salary_diff": F.round(F.col("salary") - F.coalesce(before, F.col("salary")), 2),
        }

    rows = staff(spark, sf).drop("name")
    # both plans are chosen from the base rows: the second window must not compute the first one to count its result
    sliced = [needs_slices(rows, keys, group_rows) for keys in ([], ["department"])]
    whole = framed(rows, [], [("emp_id", False)], neighbours, back=1, ahead=1, sliced=sliced[0])
    return framed(
        whole,
        ["department"],
        [("salary", True), ("emp_id", False)],
        lambda w: {"better_paid": F.lag("salary").over(w)},
        back=1,
        ahead=0,
        sliced=sliced[1],
    )


@query("first_last_value", f"""
WITH {EMP} SELECT emp_id, department, salary, first_value(salary) OVER w AS dept_max_salary,
  last_value(salary) OVER w AS dept_min_salary, first_value(name) OVER w AS top_name FROM emp
WINDOW w AS (PARTITION BY department ORDER BY salary DESC, emp_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def first_last_value(spark, sf):
    first = F.struct(-F.col("salary"), F.col("emp_id"))
    rows = attach_group(
        staff(spark, sf),
        ["department"],
        {
            "dept_max_salary": F.min_by("salary", first),
            "dept_min_salary": F.max_by("salary", first),
            "top_name": F.min_by("name", first),
        },
    )
    return rows.drop("name")


@query("running_total", f"""
WITH {EMP} SELECT emp_id, department, salary, round(CAST(sum(CAST(salary AS DECIMAL(28,10))) OVER
  (PARTITION BY department ORDER BY salary, emp_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 2) AS running_total
FROM emp""")
def running_total(spark, sf, **sizing):
    """Decimal sums, so that the plain and the sliced plan give the same digits."""
    rows = staff(spark, sf).drop("name").withColumn("amount", strict("salary"))
    rows = running(rows, ["department"], BY_PAY, {"running_total": "amount"}, **sizing).drop("amount")
    return rows.withColumn("running_total", F.round(F.col("running_total").cast("double"), 2))


@query("moving_average", f"""
WITH {EMP} SELECT emp_id, department, salary, round(avg(salary) OVER
  (PARTITION BY department ORDER BY salary, emp_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS moving_avg_3 FROM emp""")
def moving_average(spark, sf, **sizing):
    return framed(
        staff(spark, sf).drop("name"),
        ["department"],
        BY_PAY,
        lambda w: {"moving_avg_3": F.round(F.avg("salary").over(w.rowsBetween(-1, 1)), 4)},
        back=1,
        ahead=1,
        **sizing,
    )


@query("cume_dist_ntile", f"""
WITH {EMP} SELECT emp_id, salary, round(cume_dist() OVER (ORDER BY salary), 8) AS cumulative_pct,
  ntile(4) OVER (ORDER BY salary, emp_id) AS salary_quartile FROM emp""")
def cume_dist_ntile(spark, sf, **sizing):
    placed = ranked(staff(spark, sf), [], "salary", "emp_id", tiles=4, **sizing)
    return placed.select(
        "emp_id", "salary", F.round("cume", 8).alias("cumulative_pct"), F.col("tile_no").alias("salary_quartile")
    )


@query("rows_frames", f"""
WITH {EMP} SELECT emp_id, salary,
  round(sum(salary) OVER (ORDER BY salary, emp_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS sum_last_3_rows,
  round(sum(salary) OVER (ORDER BY salary, emp_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 2) AS sum_next_3_rows
FROM emp""")
def rows_frames(spark, sf, **sizing):
    return framed(
        staff(spark, sf).select("emp_id", "salary"),
        [],
        BY_PAY,
        lambda w: {
            "sum_last_3_rows": F.round(F.sum("salary").over(w.rowsBetween(-2, 0)), 2),
            "sum_next_3_rows": F.round(F.sum("salary").over(w.rowsBetween(0, 2)), 2),
        },
        back=2,
        ahead=2,
        **sizing,
    )


@query("range_frame_value", f"""
WITH {EMP} SELECT emp_id, salary, round(avg(CAST(salary AS DECIMAL(28,10))) OVER
  (ORDER BY salary RANGE BETWEEN 500 PRECEDING AND 500 FOLLOWING), 4) AS avg_within_range FROM emp""")
def range_frame_value(spark, sf, **sizing):
    rows = staff(spark, sf).select("emp_id", "salary")
    near = value_range_mean(rows, [], "salary", 500.0, "avg_within_range", **sizing)
    return near.withColumn("avg_within_range", F.round("avg_within_range", 4))


@query("named_window", f"""
WITH {EMP} SELECT emp_id, department, salary, round(avg(CAST(salary AS DECIMAL(28,10))) OVER w, 4) AS dept_avg, max(salary) OVER w AS dept_max,
  min(salary) OVER w AS dept_min, round(salary - round(avg(CAST(salary AS DECIMAL(28,10))) OVER w, 4), 4) AS delta_from_avg FROM emp
WINDOW w AS (PARTITION BY department ORDER BY salary ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def named_window(spark, sf):
    rows = attach_group(
        staff(spark, sf).drop("name"),
        ["department"],
        {"_mean": mean("salary"), "dept_max": F.max("salary"), "dept_min": F.min("salary")},
    )
    return rows.select(
        "emp_id",
        "department",
        "salary",
        F.round("_mean", 4).alias("dept_avg"),
        "dept_max",
        "dept_min",
        F.round(F.col("salary") - F.round("_mean", 4), 4).alias("delta_from_avg"),
    )
