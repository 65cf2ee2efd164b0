"""Small tables with the cases every operator must handle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))


def rows() -> list[tuple]:
    base = [
        (1, "one two three four five six seven eight nine ten", "en", "a"),
        (2, "one two three four five six seven eight nine ten", "en", "b"),
        (2, "one two three four five six seven eight nine ten", "en", "b"),  # a repeated row
        (3, "", "en", "a"), (4, None, None, "a"), (5, " \t\n ", "de", None), (None, "no id here at all", "en", "c"),
        (6, "kurz", "de", None), (7, LONG, "en", "a"), (8, LONG + " end", "en", "c"), (9, "Ärger ß 漢字 🙂   x", "de", "c"),
        (-10, "one two three four five six seven eight nine ten eleven", None, "b"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in base]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), COLUMNS)


def clashing(docs: DataFrame) -> DataFrame:
    """Extra columns named like what operators use inside."""
    for name in ("row", "key", "size", "cls", "n", "c", "score", "ids", "taken", "cut", "id", "group", "gone", "again", "_label"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COLUMNS)


def labels(spark: SparkSession, given: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(given or [], "doc_id long, quality int, toxic int")
