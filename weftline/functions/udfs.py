"""User functions: Arrow-vectorised helpers for what built-in functions cannot express, and native twins."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# The flat rate and the band limits of the salary transform.
FLAT_TAX = 0.30
SENIOR_FROM, MID_FROM = 8000.0, 5000.0


def salary_band(pay: Column) -> Column:
    return F.when(pay >= SENIOR_FROM, "Senior").when(pay >= MID_FROM, "Mid").otherwise("Junior")


def blank_as_zero(text: Column) -> Column:
    """Pay given as text; blank or missing counts as 0.0."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")).cast("double"), F.lit(0.0))


def band_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same transform over pandas batches, for callers that bring their own Python."""
    for batch in batches:
        pay = pd.to_numeric(batch["salary"].replace("", "0")).fillna(0.0)
        band = pd.cut(pay, [float("-inf"), MID_FROM, SENIOR_FROM, float("inf")], right=False,
                      labels=["Junior", "Mid", "Senior"])
        yield pd.DataFrame({"name": batch["name"], "salary": pay, "band": band.astype(str), "tax_rate": FLAT_TAX})


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition; Spark has no built-in for it."""
    return text.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFKC", s))


def clean_name(name: Column) -> Column:
    """Normalise, keep ASCII letters, spaces and hyphens, collapse spaces, capitalise every run of letters.

    ``initcap`` starts a word only after a space, so the parts around hyphens are capitalised one by one.
    """
    letters = F.regexp_replace(nfkc(name), r"[^a-zA-Z\s\-]", "")
    single = F.trim(F.regexp_replace(letters, r"\s+", " "))
    parts = F.transform(F.split(single, "-"), lambda part: F.initcap(part))
    return F.array_join(parts, "-")


def mask_email(address: Column) -> Column:
    """``alice@example.com`` becomes ``a***@example.com``."""
    return F.regexp_replace(address, r"^(.)[^@]*(@.*)$", "$1***$2")


@F.pandas_udf(DoubleType())
def after_flat_tax(pay: pd.Series) -> pd.Series:
    return pay * (1.0 - FLAT_TAX)


@F.udtf(returnType="word: string, place: int", useArrow=True)
class TokenizeRows:
    """One text in, one row per token out."""

    def eval(self, text: str):
        if text is None:
            return
        for place, word in enumerate(w for w in text.lower().split() if w):
            yield word, place


def register(spark: SparkSession) -> None:
    spark.udf.register("after_flat_tax", after_flat_tax)
    spark.udtf.register("tokenize_rows", TokenizeRows)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION mask_email(address STRING) RETURNS STRING "
              "RETURN regexp_replace(address, '^(.)[^@]*(@.*)$', '$1***$2')")
