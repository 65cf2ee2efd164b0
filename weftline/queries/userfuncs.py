"""Script transforms, aggregate and table functions, registered functions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from weftline.adapters import EMP, emp, money_text, table
from weftline.functions.numbers import mean
from weftline.functions.udfs import FLAT_TAX, band_batches, blank_as_zero, clean_name, mask_email, register, salary_band
from weftline.operators.mapreduce import map_pairs, reduce_sorted
from weftline.plans.sizing import spread
from weftline.registry import query

BAND = "CASE WHEN pay >= 8000 THEN 'Senior' WHEN pay >= 5000 THEN 'Mid' ELSE 'Junior' END"
TEXT_PAY = "CASE WHEN emp_id % 50 = 0 THEN 0.0 ELSE salary END"


def with_text_pay(spark, sf):
    """Pay as text with some blanks, the shape a script sees on its input."""
    return emp(spark, sf).select(
        "name", F.when(F.col("emp_id") % 50 == 0, "").otherwise(money_text("salary")).alias("salary"), "department"
    )


@query("transform_salary_band", f"""
WITH {EMP}, p AS (SELECT name, {TEXT_PAY} AS pay FROM emp)
SELECT name, pay AS salary, {BAND} AS band, CAST(0.3 AS DOUBLE) AS tax_rate FROM p""")
def transform_salary_band(spark, sf):
    pay = blank_as_zero(F.col("salary"))
    rows = with_text_pay(spark, sf).select("name", pay.alias("salary"))
    return rows.select("name", "salary", salary_band(F.col("salary")).alias("band"), F.lit(FLAT_TAX).alias("tax_rate"))


@query("transform_then_filter", f"""
WITH {EMP}, p AS (SELECT name, {TEXT_PAY} AS pay FROM emp)
SELECT name, pay AS salary, {BAND} AS band FROM p WHERE pay >= 8000""")
def transform_then_filter(spark, sf):
    """The batch form of the same transform, filtered afterwards."""
    out = "name string, salary double, band string, tax_rate double"
    return with_text_pay(spark, sf).mapInPandas(band_batches, out).filter("band = 'Senior'").drop("tax_rate")


@query("clean_name", r"""
WITH raw AS (SELECT c_custkey AS emp_id, '  jean-' || lower(c_mktsegment) || ' o''' || c_name || ' ' AS name,
  n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT emp_id, 'Jean-' || upper(substr(seg, 1, 1)) || substr(seg, 2) || ' Ocustomer' AS clean_name,
  CAST(length(seg) + 15 AS INTEGER) AS name_length, substr(upper(country), 1, 2) AS country_code
FROM (SELECT *, regexp_extract(name, 'jean-(\w+)', 1) AS seg FROM raw)""")
def clean_names(spark, sf):
    raw = F.concat(F.lit("  jean-"), F.lower("department"), F.lit(" o'"), "name", F.lit(" "))
    cleaned = emp(spark, sf).select("emp_id", clean_name(raw).alias("clean_name"), "country")
    return cleaned.select(
        "emp_id",
        "clean_name",
        F.length("clean_name").alias("name_length"),
        F.substring(F.upper("country"), 1, 2).alias("country_code"),
    )


@query("grouped_summary_udaf", f"""
WITH {EMP} SELECT department, count(*) AS headcount, round(avg(CAST(salary AS DECIMAL(28,10))), 2) AS avg_salary,
  round(max(salary) - min(salary), 2) AS salary_range FROM emp GROUP BY department""")
def grouped_summary_udaf(spark, sf):
    return emp(spark, sf).groupBy("department").agg(
        F.count("*").alias("headcount"),
        F.round(mean("salary"), 2).alias("avg_salary"),
        F.round(F.max("salary") - F.min("salary"), 2).alias("salary_range"),
    )


@query("mask_email", r"""
SELECT c_custkey AS emp_id, substr(lower(c_name), 1, 1) || '***@' || lower(c_mktsegment) || '.example.com' AS masked
FROM customer""")
def masked_emails(spark, sf):
    customer = table(spark, sf, "customer")
    address = F.concat(
        F.regexp_replace(F.lower("c_name"), "#", "."), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com")
    )
    return customer.select(F.col("c_custkey").alias("emp_id"), mask_email(address).alias("masked"))


@query("registered_function", """
SELECT c_custkey, round(c_acctbal * 0.7, 4) AS net,
  substr(c_name, 1, 1) || '***@example.com' AS masked FROM customer""")
def registered_function(spark, sf):
    register(spark)
    table(spark, sf, "customer").createOrReplaceTempView("weft_fn_customer")
    return spark.sql("""
        SELECT c_custkey, round(after_flat_tax(c_acctbal), 4) AS net,
               mask_email(concat(c_name, '@example.com')) AS masked FROM weft_fn_customer""")


#: The side file of words that are not counted.
SKIPPED = ("that", "with", "this", "dass", "nicht", "pour", "dans", "para", "como")


def words_of_texts(rows: pd.DataFrame, side: dict) -> pd.DataFrame:
    """A mapper: (word, doc_id, occurrences in the text) for words of at least ``shortest`` letters that are not skipped."""
    skipped, shortest = side["skipped"], side["shortest"]
    words, places, values = [], [], []
    for doc_id, text in zip(rows["doc_id"].tolist(), rows["text"], strict=True):
        counts = Counter((text or "").lower().split())
        found = [(w, n) for w, n in counts.items() if len(w) >= shortest and w not in skipped]
        words += [w for w, _ in found]
        values += [n for _, n in found]
        places += [doc_id] * len(found)
    return pd.DataFrame({"key": pd.Series(words, dtype="object"), "place": pd.Series(places, dtype="int64"),
                         "value": pd.Series(values, dtype="int64")})


class Gaps:
    """A reducer that depends on the order: occurrences, documents, and the widest gap from one document to the next."""

    def start(self):
        return (0, 0, None, None, 0)  # occurrences, documents, first and last document, widest gap

    def step(self, state, places, values):
        if len(places) == 1:  # most words of a text are rare
            return self.merge(state, (int(values[0]), 1, int(places[0]), int(places[0]), 0))
        gaps = np.diff(places)
        return self.merge(state, (int(values.sum()), 1 + int(np.count_nonzero(gaps)), int(places[0]), int(places[-1]),
                                  int(gaps.max())))

    def merge(self, left, right):
        if left[2] is None:
            return right
        gap = right[2] - left[3]
        return (left[0] + right[0], left[1] + right[1] - (gap == 0), left[2], right[3], max(left[4], gap, right[4]))

    def finish(self, key, state):
        return key, state[0], state[1], state[4]


@query("streaming_mapreduce", r"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(trim(lower(text), E' \t\n\r'), '\s+')) AS word FROM documents),
kept AS (SELECT * FROM w WHERE length(word) >= 4 AND word NOT IN (%s)),
gaps AS (SELECT word, doc_id - lag(doc_id) OVER (PARTITION BY word ORDER BY doc_id) AS gap FROM kept)
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs, max(widest) AS widest_gap
FROM kept JOIN (SELECT word, coalesce(max(gap), 0) AS widest FROM gaps GROUP BY word) USING (word) GROUP BY word"""
       % ", ".join(f"'{w}'" for w in SKIPPED))
def streaming_mapreduce(spark, sf, shortest: int = 4, slices: int | None = None):
    """A Python mapper with parameters and a side file, and a Python reducer over the sorted values of each word."""
    texts = spread(table(spark, sf, "documents").select("doc_id", "text"))
    pairs = map_pairs(texts, words_of_texts, "key string, place long, value long", "text",
                      {"shortest": shortest, "skipped": frozenset(SKIPPED)})
    return reduce_sorted(pairs, lambda side: Gaps(), "word string, n long, docs long, widest_gap long", slices=slices)


@query("tokenize_udtf", r"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(trim(lower(text), E' \t\n\r'), '\s+')) AS word FROM documents)
SELECT doc_id, count(*) AS tokens, count(DISTINCT word) AS words FROM w WHERE word <> '' GROUP BY doc_id""")
def tokenize_udtf(spark, sf):
    register(spark)
    spread(table(spark, sf, "documents").select("doc_id", "text")).createOrReplaceTempView("weft_udtf_docs")
    return spark.sql("""
        SELECT doc_id, count(*) AS tokens, count(DISTINCT word) AS words
        FROM weft_udtf_docs, LATERAL tokenize_rows(text) GROUP BY doc_id""")
