"""How filters interact: what each removes at each step of every order they could run in.

Only the set of filters a document fails matters, so documents are counted by that set (a mask) first. In a given order a
document goes at the first filter of its mask. All orders that begin with the same filters are neighbours in lexicographic
order: a mask is removed by filter f at step s in those orders whose first s - 1 filters are outside the mask and whose s-th is
f, and each such beginning covers one interval of (k - s)! ranks, which its Lehmer code gives. So the counts of a mask are
added at the start of its intervals and taken away at their ends, and a running sum over the ranks gives every order at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: The limits of the five filters.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 100, 80, 10, "#$%&*|"
FILTERS = "ABCDE"
SALTS = 64


def text_mask(text: str | None) -> int:
    """Bits 0 to 3: too short, too repetitive, too many capitals, symbols. A null text is the empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    octets = np.frombuffer(raw, np.uint8)
    upper = int(np.count_nonzero((octets >= 65) & (octets <= 90)))
    return ((len(words) < LEAST_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > UPPER_PERCENT * len(text)) << 2 | any(c in text for c in SYMBOLS) << 3)


@F.pandas_udf(IntegerType())
def masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_mask(t) for t in batch], dtype="int32")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: filter i fails), n, good, toxic: the documents of each language by the filters they fail.

    Equal texts are recognised by SHA-256 over the whole table, null texts as empty ones; a document repeats an earlier one if a
    smaller doc_id has its text, whether other filters remove that one or not. A null doc_id is neither smaller nor larger
    than others. A repeated row counts once each time and does not repeat itself. The null language is the empty one. A
    document labelled more than once is good or toxic if any label says so; without a label it is neither.

    Rows of one text are counted by language and labels before they meet, so copies of one text, however many, are a few rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("doc_id").alias("id"),
        masked(F.col("text").cast("string")).alias("mask"), F.unhex(F.sha2(text.cast("string"), 256)).alias("same"))
    # null ids match no label: spread them, or they would all meet in one task
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("same") % SALTS).otherwise(0))
    marked = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    ).withColumn("salt", F.lit(0).cast("long"))
    rows = rows.join(marked, ["id", "salt"], "left").fillna(0, ["good", "toxic"])
    kinds = ["same", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy("id", "salt", *kinds).agg(F.count("*").alias("n"))
    by_text = by_id.groupBy(*kinds, F.col("id").isNull().alias("no_id")).agg(
        F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    smallest = F.min("first.id").over(W.partitionBy("same"))
    by_text = by_text.withColumn("smallest", smallest)
    originals = F.when(F.col("no_id"), F.col("n")).when(F.col("first.id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    last = 1 << (len(FILTERS) - 1)
    split = by_text.withColumn("kind", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("n")),
        F.struct((F.col("mask") + last).alias("mask"), (F.col("n") - originals).alias("n")))))
    return split.groupBy("part", F.col("kind.mask").alias("mask")).agg(
        F.sum("kind.n").alias("n"), F.sum(F.col("kind.n") * F.col("good")).alias("good"),
        F.sum(F.col("kind.n") * F.col("toxic")).alias("toxic"))


def lehmer_rank(prefix: tuple[int, ...], filters: int) -> int:
    """Rank of the first order, in lexicographic order, that begins with ``prefix``."""
    left, rank = list(range(filters)), 0
    for i, f in enumerate(prefix):
        at = left.index(f)
        rank += at * factorial(filters - 1 - i)
        left.pop(at)
    return rank


def intervals(filters: int) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of all orders in which the mask goes at that step."""
    for mask in range(1, 1 << filters):
        outside = [f for f in range(filters) if not mask >> f & 1]
        for step in range(1, len(outside) + 2):
            for before in permutations(outside, step - 1):
                for f in range(filters):
                    if mask >> f & 1:
                        low = lehmer_rank((*before, f), filters)
                        yield mask, step, low, low + factorial(filters - step)


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, zeros included; parts are those of ``counts``.

    ``counts`` has part, mask, n, good, toxic with one or more rows per part and mask (nulls count as 0); no rows give no
    rows. The table of intervals depends on the number of filters alone (840 rows for five); at most 8 filters are taken.
    """
    k = len(filters)
    if not 1 <= k <= 8:
        raise ValueError("audit takes 1 to 8 filters")
    spark = counts.sparkSession
    orders = ["".join(p) for p in permutations(filters)]  # lexicographic in the positions of ``filters``
    cover = spark.createDataFrame(list(intervals(k)), "mask int, step int, low int, high int")
    counts = counts.fillna(0, ["n", "good", "toxic"]).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).repartition("part")
    values = ("n", "good", "toxic")

    def at(rank: Column, sign: int) -> Column:
        return F.struct(rank.alias("rank"), *[(F.col(v) * sign).alias(v) for v in values])

    marks = counts.join(F.broadcast(cover), "mask").select(
        "part", "step", F.explode(F.array(at(F.col("low"), 1), at(F.col("high"), -1))).alias("m")).select("part", "step", "m.*")
    zero = F.lit(0).cast("long")
    steps = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    grid = steps.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"),
                        *[zero.alias(v) for v in values])
    changes = marks.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(v).alias(v) for v in values])
    along = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    gone = changes.select("part", "step", "rank", *[F.sum(v).over(along).alias(v) for v in values]).filter(
        F.col("rank") < len(orders))
    order = F.element_at(F.array(*[F.lit(o) for o in orders]), F.col("rank") + 1)
    gone = gone.withColumn("filter_order", order).withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    per_filter = counts.withColumn("f", F.explode(F.array(*[
        F.struct(F.lit(name).alias("filter"), F.lit(1 << i).alias("bit")) for i, name in enumerate(filters)])))
    bit = F.col("f.bit")
    per_filter = per_filter.groupBy("part", F.col("f.filter").alias("filter")).agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("mask").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == bit, F.col("n")).otherwise(0)).alias("unique_fails"))
    so_far = W.partitionBy("part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return gone.join(per_filter, ["part", "filter"]).select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(W.partitionBy("part", "filter")).alias("shapley"))


#: The same in SQL, order by order.
SQL = r"""
WITH lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failed AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS mask
  FROM docs),
counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN lab USING (doc_id) GROUP BY part, mask),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (SELECT o, s, substr(o, s, 1) AS f, substr(o, 1, s - 1) AS before FROM orders, (SELECT unnest(range(1, 6)) AS s)),
cells AS (
  SELECT part, o, s, f,
    sum(n) FILTER (WHERE translate(before || f, mask, '') = before || f) AS kept,
    sum(n) FILTER (WHERE contains(mask, f) AND translate(before, mask, '') = before) AS removed,
    sum(n) FILTER (WHERE contains(mask, f) AND translate(before, mask, '') <> before) AS redundant,
    sum(n) FILTER (WHERE mask = f) AS unique_fails,
    sum(good) FILTER (WHERE contains(mask, f) AND translate(before, mask, '') = before) AS good_lost,
    sum(toxic) FILTER (WHERE contains(mask, f) AND translate(before, mask, '') = before) AS toxic_lost
  FROM counts, steps GROUP BY part, o, s, f)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM cells
"""
