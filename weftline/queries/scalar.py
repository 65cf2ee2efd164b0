"""Projections, filters, conditionals and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, EMP_H, emp, emp_hired, table
from weftline.functions.numbers import mean
from weftline.functions.text import strip_punctuation, words_unicode
from weftline.plans.sizing import spread
from weftline.registry import query

# The date reports count from; the wall clock would make them unrepeatable.
AS_OF = "2026-12-01"


@query("project_filter_sort", f"""
WITH {EMP} SELECT name, salary, country FROM emp
WHERE department = 'BUILDING' AND salary > 7000 ORDER BY salary DESC, name""")
def project_filter_sort(spark, sf):
    return (
        emp(spark, sf)
        .filter((F.col("department") == "BUILDING") & (F.col("salary") > 7000))
        .select("name", "salary", "country")
        .orderBy(F.desc("salary"), "name")
    )


@query("computed_columns", f"""
WITH {EMP} SELECT name, salary, round(salary / 12.0, 4) AS monthly_salary, upper(name) AS upper_name FROM emp""")
def computed_columns(spark, sf):
    return emp(spark, sf).select(
        "name", "salary", F.round(F.col("salary") / 12.0, 4).alias("monthly_salary"), F.upper("name").alias("upper_name")
    )


@query("case_bands", f"""
WITH {EMP} SELECT name, salary,
  CASE WHEN salary >= 8000 THEN 'Senior' WHEN salary >= 5000 THEN 'Mid-level' ELSE 'Junior' END AS level,
  round(CASE WHEN country = 'NATION_1' THEN salary * 0.75 ELSE salary * 0.8 END, 4) AS after_tax
FROM emp""")
def case_bands(spark, sf):
    level = F.when(F.col("salary") >= 8000, "Senior").when(F.col("salary") >= 5000, "Mid-level").otherwise("Junior")
    rate = F.when(F.col("country") == "NATION_1", 0.75).otherwise(0.8)
    return emp(spark, sf).select(
        "name", "salary", level.alias("level"), F.round(F.col("salary") * rate, 4).alias("after_tax")
    )


@query("null_filter", f"""
WITH {EMP}, maybe AS (SELECT emp_id, CASE WHEN salary < 1000 THEN NULL ELSE salary - 5000 END AS surplus FROM emp)
SELECT emp_id, round(surplus, 2) AS surplus FROM maybe WHERE surplus > 0 AND surplus IS NOT NULL""")
def null_filter(spark, sf):
    surplus = F.when(F.col("salary") >= 1000, F.col("salary") - 5000)
    maybe = emp(spark, sf).select("emp_id", surplus.alias("surplus"))
    return maybe.filter((F.col("surplus") > 0) & F.col("surplus").isNotNull()).select(
        "emp_id", F.round("surplus", 2).alias("surplus")
    )


@query("fill_nulls", f"""
WITH {EMP} SELECT emp_id,
  coalesce(CASE WHEN salary >= 0 THEN salary END, 0.0) AS salary,
  coalesce(CASE WHEN department <> 'MACHINERY' THEN department END, 'Unknown') AS department FROM emp""")
def fill_nulls(spark, sf):
    holes = emp(spark, sf).select(
        "emp_id",
        F.when(F.col("salary") >= 0, F.col("salary")).alias("salary"),
        F.when(F.col("department") != "MACHINERY", F.col("department")).alias("department"),
    )
    return holes.fillna({"salary": 0.0, "department": "Unknown"})


@query("cast_string_numeric", f"""
WITH {EMP}, texted AS (SELECT department,
  CASE WHEN emp_id % 10 = 0 THEN 'n/a' ELSE CAST(CAST(salary AS DECIMAL(18,2)) AS VARCHAR) END AS salary_text FROM emp)
SELECT department, count(*) AS headcount, count(TRY_CAST(salary_text AS DOUBLE)) AS numeric_rows,
       round(avg(TRY_CAST(salary_text AS DECIMAL(28,10))), 4) AS avg_salary
FROM texted GROUP BY department""")
def cast_string_numeric(spark, sf):
    texted = emp(spark, sf).select(
        "department",
        F.when(F.col("emp_id") % 10 == 0, "n/a")
        .otherwise(F.col("salary").cast("decimal(18,2)").cast("string"))
        .alias("salary_text"),
    )
    number = F.col("salary_text").try_cast("double")
    return texted.groupBy("department").agg(
        F.count("*").alias("headcount"),
        F.count(number).alias("numeric_rows"),
        F.round(mean(number), 4).alias("avg_salary"),
    )


@query("cte_query", f"""
WITH {EMP}, dept_avg AS (SELECT department, avg(CAST(salary AS DECIMAL(28,10))) AS avg_sal FROM emp GROUP BY department)
SELECT e.name, e.salary, round(d.avg_sal, 4) AS avg_sal FROM emp e JOIN dept_avg d ON e.department = d.department
WHERE e.salary > d.avg_sal""")
def cte_query(spark, sf):
    emp(spark, sf).createOrReplaceTempView("weft_cte_emp")
    return spark.sql("""
        WITH dept_avg AS (SELECT department, CAST(sum(CAST(salary AS DECIMAL(18,2))) * 100 AS DOUBLE) / (count(salary) * 100) AS avg_sal FROM weft_cte_emp GROUP BY department)
        SELECT e.name, e.salary, round(d.avg_sal, 4) AS avg_sal
        FROM weft_cte_emp e JOIN dept_avg d ON e.department = d.department
        WHERE e.salary > d.avg_sal""")


@query("string_functions", f"""
WITH {EMP} SELECT emp_id, upper(name) AS upper_name, lower(name) AS lower_name,
  CAST(length(name) AS INTEGER) AS name_len, substr(name, 1, 3) AS name_prefix,
  concat(name, ' (', country, ')') AS name_country FROM emp""")
def string_functions(spark, sf):
    return emp(spark, sf).select(
        "emp_id",
        F.upper("name").alias("upper_name"),
        F.lower("name").alias("lower_name"),
        F.length("name").alias("name_len"),
        F.substring("name", 1, 3).alias("name_prefix"),
        F.concat("name", F.lit(" ("), "country", F.lit(")")).alias("name_country"),
    )


@query("date_functions", f"""
WITH {EMP_H}, parts AS (
  SELECT emp_id, hire_date, DATE '{AS_OF}' AS as_of,
    12 * (year(DATE '{AS_OF}') - year(hire_date)) + month(DATE '{AS_OF}') - month(hire_date) AS months,
    day(DATE '{AS_OF}') AS d1, day(hire_date) AS d2,
    DATE '{AS_OF}' = last_day(DATE '{AS_OF}') AND hire_date = last_day(hire_date) AS both_last
  FROM emp_h)
SELECT emp_id, hire_date, CAST(year(hire_date) AS INTEGER) AS hire_year, CAST(month(hire_date) AS INTEGER) AS hire_month,
  round(CASE WHEN d1 = d2 OR both_last THEN CAST(months AS DOUBLE) ELSE months + (d1 - d2) / 31.0 END / 12, 4) AS years_employed
FROM parts""")
def date_functions(spark, sf):
    months = F.months_between(F.lit(AS_OF).cast("date"), F.col("hire_date"))
    return emp_hired(spark, sf).select(
        "emp_id",
        "hire_date",
        F.year("hire_date").alias("hire_year"),
        F.month("hire_date").alias("hire_month"),
        F.round(months / 12, 4).alias("years_employed"),
    )


@query("date_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS formatted_date, strftime(o_orderdate, '%Y/%m') AS year_month
FROM orders""")
def date_format(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("formatted_date"),
        F.date_format("o_orderdate", "yyyy/MM").alias("year_month"),
    )


@query("math_round", f"""
WITH {EMP}, cents AS (SELECT *, CAST(round(salary * 100) AS BIGINT) AS c FROM emp)
SELECT emp_id, sign(c) * ((2 * abs(c) + 12) // 24) / 100.0 AS monthly_salary, round(salary * 1.10, 3) AS raised,
  round(salary * 1.10 - salary, 3) AS difference FROM cents""")
def math_round(spark, sf):
    raised = F.col("salary") * 1.10
    exact = F.col("salary").cast("decimal(18,2)")  # halves of a cent must round up, whatever the double says
    return emp(spark, sf).select(
        "emp_id",
        F.round(exact / 12, 2).cast("double").alias("monthly_salary"),
        F.round(raised, 3).alias("raised"),
        F.round(raised - F.col("salary"), 3).alias("difference"),
    )


@query("regex_clean", r"""
SELECT doc_id, CAST(length(regexp_replace(lower(text), '[^\w\s]', '', 'g')) AS INTEGER) AS clean_length,
  regexp_matches(text, '\w{2,}') AS has_word FROM documents""")
def regex_clean(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.length(strip_punctuation(F.lower("text"))).alias("clean_length"),
        F.col("text").rlike(r"\w{2,}").alias("has_word"),
    )


@query("tokenize_explode", r"""
SELECT doc_id, word, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY doc_id, word""")
def tokenize_explode(spark, sf):
    texts = spread(table(spark, sf, "documents").select("doc_id", "text"))
    words = texts.select("doc_id", F.explode(words_unicode(F.col("text"))).alias("word"))
    return words.filter("word <> ''").groupBy("doc_id", "word").agg(F.count("*").alias("n"))
