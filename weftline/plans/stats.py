"""Column profiles: mergeable sketches per partition, and exact counts on demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch sizes: distinct values within 1.04 / sqrt(2^LG_K) (one standard error), ranks within about 1 percent, and the
#: counters kept for frequent values.
LG_K, RANK_K, COUNTERS = 13, 300, 256
WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _ranked(kind: str) -> bool:
    return kind in (*WHOLE_NUMBERS, "float", "double") or kind.startswith("decimal")


def _sketches(c: str, kind: str) -> Column:
    """Everything one scan can say about a column, each part of bounded size and mergeable."""
    value = F.col(c)
    ranks = F.kll_sketch_agg_double(value.cast("double"), RANK_K) if _ranked(kind) else F.lit(None).cast("binary")
    return F.struct(
        F.count_if(value.isNull()).alias("nulls"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.hll_sketch_agg(value.cast("string"), LG_K).alias("distinct"), ranks.alias("ranks"),
        F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {COUNTERS})").alias("top"),
    ).alias(c)


def sketch_partitions(df: DataFrame, partition: str) -> DataFrame:
    """One row per value of ``partition``: ``part``, ``n_rows`` and a struct of sketches per other column.

    Sketches are built before the shuffle, so a task sends one row per partition it saw, whatever the rows and values; a hot
    partition is many tasks. Null is a partition like any other. The result may be stored: a new partition adds its row
    and `merged` needs no other data.
    """
    kinds = {c: kind for c, kind in df.dtypes if c != partition}
    return df.groupBy(F.col(partition).cast("string").alias("part")).agg(
        F.count("*").alias("n_rows"), *[_sketches(c, kind) for c, kind in kinds.items()])


def merged(parts: DataFrame) -> DataFrame:
    """The single row of the whole table from the rows of its partitions; ``part`` is null. No partitions give no row.

    Grouped by a constant: a task without rows must not send the empty state of a frequency sketch, which has no form.
    """
    kinds = {f.name: f.dataType["low"].dataType.simpleString() for f in parts.schema if f.name not in ("part", "n_rows")}

    def ranks(c: str, kind: str) -> Column:
        return F.kll_merge_agg_double(f"`{c}`.ranks", RANK_K) if _ranked(kind) else F.lit(None).cast("binary")

    return parts.groupBy(F.lit(0).alias("_all")).agg(F.sum("n_rows").alias("n_rows"), *[
        F.struct(
            F.sum(f"`{c}`.nulls").alias("nulls"), F.min(f"`{c}`.low").alias("low"), F.max(f"`{c}`.high").alias("high"),
            F.hll_union_agg(f"`{c}`.distinct").alias("distinct"),
            ranks(c, kind).alias("ranks"),
            F.expr(f"approx_top_k_combine(`{c}`.top, {COUNTERS})").alias("top"),
        ).alias(c) for c, kind in kinds.items()
    ]).drop("_all").select(F.lit(None).cast("string").alias("part"), "*")


def described(sketches: DataFrame, frequent: int = 3) -> DataFrame:
    """Sketch rows as a report, one row per part and column.

    ``part, column_name, n_rows, nulls, low, high`` are exact; ``distinct_estimate``, ``median_estimate`` (null for columns that
    are no numbers, and where all values are null) and ``frequent`` (the most frequent values with their counts) are estimates.
    """
    columns = [c for c in sketches.columns if c not in ("part", "n_rows")]

    def told(c: str) -> Column:
        s = F.col(f"`{c}`")
        filled = s["nulls"] < F.col("n_rows")
        quantile = F.kll_sketch_get_quantile_double(s["ranks"], F.lit(0.5))
        return F.struct(
            s["nulls"].alias("nulls"), s["low"].cast("string").alias("low"), s["high"].cast("string").alias("high"),
            F.hll_sketch_estimate(s["distinct"]).alias("distinct_estimate"),
            F.when(filled & s["ranks"].isNotNull(), quantile).alias("median_estimate"),
            F.filter(F.expr(f"approx_top_k_estimate(`{c}`.top, {frequent})"), lambda i: i["item"].isNotNull()).alias("frequent"),
        ).alias(c)

    told_rows = sketches.select("part", "n_rows", *[told(c) for c in columns])
    return told_rows.unpivot(["part", "n_rows"], columns, "column_name", "e").select("part", "column_name", "n_rows", "e.*")


def exact_distinct(df: DataFrame) -> DataFrame:
    """Exact distinct values of every column, on demand: values are counted per (column, value) first, so this shuffles every
    distinct value once; a report that may be off by a percent reads the sketches instead."""
    names = df.columns
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in names])
    values = texts.unpivot([], names, "column_name", "value").filter("value is not null")
    return values.groupBy("column_name", "value").agg(F.lit(1).alias("one")).groupBy("column_name").agg(
        F.count("*").alias("distinct_values"))
