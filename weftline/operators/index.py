"""Inverted index with posting lists of bounded length."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from weftline.plans.sizing import broadcast_if_small
from weftline.session import land

POSTINGS_PER_ROW = 100_000
#: Documents, or counted (word, file) rows, of one slice of the files.
SLICE_DOCS, SLICE_COUNTS = 4_000, 1_000_000
#: Places of frequent words in slices that may be broadcast.
PLACES = 1_000_000


def file_slices(files: DataFrame, rows: int) -> tuple[list[str], int]:
    """Where ranges of ``file`` with about ``rows`` rows begin (but the first), and the rows of the fullest range.

    Every core gets a range when there are rows enough. Equal files stay together, so a file with very many rows fills its range.
    """
    n = files.count()
    parts = max(-(-n // max(rows, 1)), min(files.sparkSession.sparkContext.defaultParallelism, n // 100), 1)
    ranges = files.select("file").repartitionByRange(parts, "file").groupBy(F.spark_partition_id().alias("slice"))
    found = ranges.agg(F.min("file").alias("low"), F.count("*").alias("n")).collect()  # one row a range
    return sorted(r["low"] for r in found if r["low"] is not None)[1:], max((r["n"] for r in found), default=0)


def with_slice(df: DataFrame, bounds: list[str]) -> DataFrame:
    """``slice``: the range that ``file`` falls into, null first. Each is one partition."""

    @F.pandas_udf(IntegerType())
    def slice_of(files: pd.Series) -> pd.Series:
        return files.map(lambda f: 0 if f is None else bisect.bisect_right(bounds, f)).astype("int32")

    return df.withColumn("slice", slice_of("file")).repartitionById(len(bounds) + 1, "slice")


def count_tokens(tokens: DataFrame, *keys: str) -> DataFrame:
    return tokens.filter(F.col("word") != "").groupBy(*keys, "word", "file").agg(F.count("*").alias("n"))


def inverted_index(tokens: DataFrame, per_row: int = POSTINGS_PER_ROW, group_rows: int = SLICE_COUNTS) -> DataFrame:
    """(word, file) tokens to ``word, part, postings`` with postings ``file:count`` in file order.

    Counts come first, so a list holds distinct files. A word found in more than ``per_row`` files continues in
    further parts; its list never sits in one task. The counts are written once: cutting the files into slices of about
    ``group_rows`` counts and building the lists must not tokenise the texts twice.
    """
    counts = land(count_tokens(tokens), "counts")
    bounds, _ = file_slices(counts, group_rows)
    return lists_of_slices(with_slice(counts, bounds), len(bounds) + 1, per_row)


def index_documents(
    docs: DataFrame, words: Column, per_row: int = POSTINGS_PER_ROW, group_rows: int = SLICE_DOCS
) -> DataFrame:
    """The `inverted_index` of the array ``words`` of every row of ``docs`` (file and what ``words`` is made of).

    Documents are dealt by file before they are split into words, so a slice's words are counted and listed where they are
    and no row for each (word, file) is shuffled. If a file has so many rows that its slice would be uneven, the tokens are
    counted before they are dealt.
    """
    bounds, fullest = file_slices(docs, group_rows)
    if fullest > 4 * max(group_rows, 1):
        return inverted_index(docs.select("file", F.explode(words).alias("word")), per_row)
    tokens = with_slice(docs, bounds).select("slice", "file", F.explode(words).alias("word"))
    return lists_of_slices(count_tokens(tokens, "slice"), len(bounds) + 1, per_row)


def lists_of_slices(counts: DataFrame, slices: int, per_row: int) -> DataFrame:
    """Lists of (slice, word, file, n), a slice in one partition, joined to those of the words.

    A slice holds a range of the files, so lists need no sorting beyond their slice. Only words in more than ``per_row`` files
    have further parts; where a slice's list begins among them follows from the sizes of the lists, one short row each.
    """
    entry = F.concat("file", F.lit(":"), F.col("n").cast("string")).alias("entry")
    bag = F.sort_array(F.collect_list(F.struct("file", entry)))
    lists = counts.groupBy("slice", "word").agg(bag.alias("bag"))
    lists = land(lists.select("slice", "word", F.size("bag").alias("n"), F.col("bag.entry").alias("bag")), "postings")

    sizes = lists.select("word", "slice", "n")
    # a word in more than per_row files is in more than per_row / slices files of some slice
    able = sizes.filter(F.col("n") * F.lit(slices).cast("long") > per_row).select("word").distinct()
    of_word = W.partitionBy("word")
    places = sizes.join(broadcast_if_small(land(able, "frequent")), "word", "left_semi").select(
        "word", "slice", (F.sum("n").over(of_word.orderBy("slice")) - F.col("n")).alias("before"), F.sum("n").over(of_word).alias("all"))
    places = land(places.filter(F.col("all") > per_row).select("word", "slice", "before"), "places")

    placed = lists.join(broadcast_if_small(places, PLACES), ["word", "slice"], "left").withColumn(
        "before", F.coalesce("before", F.lit(0).cast("long")))
    longer = F.col("before") % per_row + F.col("n") > per_row
    first, last = (F.floor(x / per_row).cast("long") for x in (F.col("before"), F.col("before") + F.col("n") - 1))
    pieces = placed.withColumn("part", F.explode(F.when(F.col("before") + F.col("n") <= per_row, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(first, last))))
    begin = F.greatest(F.col("part") * per_row - F.col("before"), F.lit(0))
    piece = F.when(longer, F.slice("bag", (begin + 1).cast("int"), F.least(
        (F.col("part") + 1) * per_row - F.col("before") - begin, F.col("n") - begin).cast("int"))).otherwise(F.col("bag"))
    text = F.nullif(F.array_join(piece, ","), F.lit(""))
    cut = pieces.select("word", "part", F.struct("slice", text.alias("text")).alias("piece"))
    joined = F.sort_array(F.collect_list("piece"))
    return cut.groupBy("word", "part").agg(joined.alias("pieces")).select(
        "word", "part", F.array_join("pieces.text", ",").alias("postings"))
