"""File readers and writers: delimited, text, columnar, key/value containers, evolving schemas, inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).csv(path, header=False)


def split_fields(lines: DataFrame, names: list[str], at_least: int, sep: str = ",", column: str = "value") -> DataFrame:
    """Untyped lines as text columns, trimmed. Lines with fewer than ``at_least`` fields are dropped; later ones may lack."""
    fields = F.split(F.trim(column), sep)
    kept = lines.select(fields.alias("_f")).filter(F.size("_f") >= at_least)
    return kept.select(*[F.trim(F.get("_f", F.lit(i))).alias(n) for i, n in enumerate(names)])


def read_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """``word TAB count`` lines; a line without exactly two fields or with a count that is no number is dropped."""
    fields = F.split(column, "\t")
    pairs = lines.select(fields.alias("_f")).filter(F.size("_f") == 2)
    typed = pairs.select(F.col("_f")[0].alias("word"), F.col("_f")[1].try_cast("bigint").alias("n"))
    return typed.filter(F.col("n").isNotNull())


def read_with_file_name(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the name of the file they come from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path, bytes, modification time. File contents are never read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", F.col("length").alias("bytes"), "modificationTime")


def folder_totals(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per folder."""
    files = inventory(spark, path).withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    return files.groupBy("folder").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("modificationTime").alias("modified")
    )


def rows_per_folder(read: DataFrame) -> DataFrame:
    """Rows of every folder that a frame read from files comes from. Rows are counted per file first."""
    files = read.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    return files.groupBy(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder")).agg(F.sum("n").alias("n_rows"))


def save_pairs(df: DataFrame, key: str, value: str, path: str) -> None:
    """Write a binary key/value container. There is no DataFrame writer for it, so this goes through pairs."""
    df.select(key, value).rdd.map(tuple).saveAsSequenceFile(path)


def load_pairs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema)


def read_evolved(spark: SparkSession, generations: list[str], wanted: dict[str, tuple[str, object]]) -> DataFrame:
    """Read folders written under older and newer schemas as the ``wanted`` schema ``{column: (type, default)}``.

    The files of one folder have one schema. A column a folder lacks is filled with its default there; a null that is
    stored stays a null. A column no longer wanted is dropped. What breaks readers raises: a stored type that differs,
    and a wanted column without a default that a folder lacks, as after a rename.
    """
    parts = []
    for folder in generations:
        rows = spark.read.parquet(folder)
        stored = dict(rows.dtypes)
        clash = [c for c, (kind, _) in wanted.items() if c in stored and stored[c] != kind]
        if clash:
            raise TypeError(f"stored type differs for {clash} in {folder}")
        lost = [c for c, (_, default) in wanted.items() if c not in stored and default is None]
        if lost:
            raise TypeError(f"no {lost} in {folder} and no default")
        parts.append(rows.select(*[
            F.col(c) if c in stored else F.lit(default).cast(kind).alias(c) for c, (kind, default) in wanted.items()
        ]))
    return reduce(DataFrame.unionByName, parts)
