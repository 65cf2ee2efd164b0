"""Mixing sources to target weights.

Every document gets a hash-random key. In key order the documents of a source are taken whole, epoch after epoch, until
the source's budget of words is used up. Where the last epoch ends is found with distributed prefix sums: the key range
of each source is cut into slices, slices are summed, and only the slice the budget ends in is ordered row by row. The
result is one cut per source, so that what a document contributes is decided where the document is, without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from weftline.llm.common import SLICE_ROWS, key_slice, slices_for, word_count
from weftline.session import land

#: Weights in the order of the source names, repeating; a source is repeated three times at most.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: The table of sources goes through the driver and to every executor, so it must be bounded; more sources raise.
MAX_SOURCES = 100_000
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Target:
    source: str | None
    size: int
    rows: int
    target: float

    @property
    def budget(self) -> int:
        return math.floor(self.target + 0.5)


def targets(sizes: list[tuple[str | None, int, int]], weights: tuple[int, ...] = WEIGHTS,
            epochs: int = MAX_EPOCHS) -> list[Target]:
    """Share the sum of all sizes by weight; a source above its limit stops there and the excess is shared again."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    weight = {i: weights[i % len(weights)] for i in range(len(ordered))}
    left, open_, out = sum(s[1] for s in ordered), dict(weight), {}
    while open_:
        unit = left / sum(open_.values())
        over = [i for i, w in open_.items() if unit * w > epochs * ordered[i][1]]
        if not over:
            out |= {i: unit * w for i, w in open_.items()}
            break
        for i in over:
            out[i] = float(epochs * ordered[i][1])
            left -= epochs * ordered[i][1]
            del open_[i]
    return [Target(s, size, rows, out[i]) for i, (s, size, rows) in enumerate(ordered)]


def mix_key(doc_id: Column) -> Column:
    """Sixty bits of the MD5 of the id as text, shifted to the domain of `key_slice`."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.shiftleft(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 2)


def place(docs: DataFrame) -> list[Column]:
    return [mix_key(docs["doc_id"]).alias("key"), F.coalesce(docs["doc_id"], F.lit(NO_ID)).alias("id")]


def plan(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per source: its size and target, the whole epochs, and the place where the last, partial epoch ends."""
    spark = docs.sparkSession
    sized = land(docs.select(docs["source"], *place(docs), word_count(docs["text"]).alias("size")), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = totals.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goals = targets([(r["source"], r["size"], r["rows"]) for r in found])
    kind = StructType([StructField("source", StringType()), *[StructField(n, LongType()) for n in
                       ("source_size", "rows", "epochs", "rest")], StructField("target", DoubleType())])
    table = spark.createDataFrame(
        [(g.source, g.size, g.rows, g.budget // g.size if g.size else 0, g.budget % g.size if g.size else 0, g.target)
         for g in goals], kind)
    goal = F.broadcast(table.withColumnRenamed("source", "goal"))
    sliced = sized.join(goal, F.col("source").eqNullSafe(F.col("goal"))).withColumn(
        "slice", key_slice(F.col("key"), slices_for(F.col("rows"), slice_rows)))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = F.coalesce(F.sum("words").over(
        W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = sums.withColumn("before", before).filter(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
    ends = ends.select(F.col("source").alias("goal"), F.col("slice").alias("last"), "before", F.col("rest").alias("left"))
    inside = sliced.select("source", "slice", "key", "id", "size").join(
        F.broadcast(ends), F.col("source").eqNullSafe(F.col("goal")) & (F.col("slice") == F.col("last")))
    alike = inside.groupBy("source", "key", "id", "size").agg(
        F.count("*").alias("n"), F.first("before").alias("before"), F.first("left").alias("left"))
    running = F.coalesce(F.sum(F.col("n") * F.col("size")).over(
        W.partitionBy("source").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = alike.withColumn("start", F.col("before") + running).filter(
        (F.col("start") <= F.col("left")) & (F.col("left") < F.col("start") + F.col("n") * F.col("size")))
    cut = cut.select(F.col("source").alias("goal"), F.struct("key", "id", "size").alias("cut"),
                     F.floor((F.col("left") - F.col("start")) / F.col("n")).cast("long").alias("part"))
    return table.join(F.broadcast(cut), F.col("source").eqNullSafe(F.col("goal")), "left").select(
        "source", "source_size", "target", "epochs", "cut", "part")


def taken(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, their size, their source's size and target, and the words taken of them."""
    cuts = F.broadcast(sources.withColumnRenamed("source", "goal"))
    work = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *place(docs),
                       word_count(docs["text"]).alias("size"))
    here = F.struct("key", "id", "size")
    extra = F.when(F.col("cut").isNull(), F.lit(0)).when(here < F.col("cut"), F.col("size")).when(
        here == F.col("cut"), F.col("part")).otherwise(F.lit(0))
    return work.join(cuts, F.col("row")["source"].eqNullSafe(F.col("goal"))).select(
        "row", "size", "source_size", "target", (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    A null text has size 0; a null source is a source of its own, the last one. Repeated rows at the place where a budget
    ends share what is left evenly. An empty table gives an empty table.
    """
    return taken(docs.select("doc_id", "text", "source"), plan(docs)).select(
        "row.doc_id", "size", "source_size", "target", "taken")


def materialised(docs: DataFrame) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for every time a document is taken.

    At most one document of each source (or its repeated rows) is cut after its last word taken, all others are whole.
    Documents without words are no part of a mix that is measured in words.
    """
    done = taken(docs, plan(docs))
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    # pieces end with a word each, so the first ones joined are the text up to its last word taken
    pieces = F.split(F.col("row")["text"], r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    head = F.array_join(F.slice(pieces, F.lit(1), F.col("rest")), "")
    amounts = F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    rows = done.filter(F.col("taken") > 0).select("row", rest.alias("rest"), F.explode(amounts).alias("cut"))
    named = [F.when(F.col("cut") == 1, head).otherwise(F.col("row")["text"]).alias("text") if c == "text"
             else F.col("row")[c].alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        text = next(x for x, c in zip(named, docs.columns, strict=True) if c == "text")
        named = [F.when(F.col("cut") == 1, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("row")["n_chars"]).alias("n_chars") if c == "n_chars" else x
            for x, c in zip(named, docs.columns, strict=True)]
    return rows.select(*named)


SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3.0 * s / w AS r, sum(s) OVER () AS total, sum(w) OVER () AS all_w,
         coalesce(sum(3 * s) OVER (ORDER BY 3.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
         coalesce(sum(w) OVER (ORDER BY 3.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cw
  FROM sources),
unit AS (
  SELECT CAST(total - c AS DOUBLE) / (all_w - cw) AS u FROM ordered
  WHERE CAST(total - c AS DOUBLE) / (all_w - cw) <= r ORDER BY r, source LIMIT 1),
goals AS (
  SELECT source AS g, s, least(3.0 * s, u * w)::DOUBLE AS target,
         CAST(floor(least(3.0 * s, u * w) + 0.5) AS BIGINT) AS budget
  FROM ordered, unit),
placed AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, s, target, budget,
         sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized JOIN goals ON source IS NOT DISTINCT FROM g)
SELECT doc_id, size, s AS source_size, target,
       CAST(CASE WHEN s = 0 THEN 0
            ELSE (budget // s) * size + greatest(0, least(size, budget % s - before)) END AS BIGINT) AS taken
FROM placed
"""
