"""Column masks, row policies, column rules and content checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.sizing import broadcast_if_small


def last_four(number: Column) -> Column:
    """All but the last four digits hidden; short numbers are padded with zeros."""
    text = number.cast("string")
    padded = F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)
    return F.concat(F.lit("XXXX-XXXX-"), F.right(padded, F.lit(4)))


def rows_for(df: DataFrame, policy: DataFrame, user: str, column: str) -> DataFrame:
    """Rows whose ``column`` is granted to ``user`` in ``policy(user, <column>)``."""
    granted = policy.filter(F.col("user") == user).select(column).distinct()
    return df.join(broadcast_if_small(granted), column, "left_semi")


def allowed_columns(columns: list[str], rules: list[tuple[str, str]]) -> list[str]:
    """Columns left by ``(effect, column or *)`` rules: something must allow a column and nothing may deny it."""

    def hit(effect: str, column: str) -> bool:
        return any(e == effect and c in ("*", column) for e, c in rules)

    return [c for c in columns if hit("allow", c) and not hit("deny", c)]


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free content sum; copies count, unlike with exclusive or."""
    hashed = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(hashed).alias("content"))
