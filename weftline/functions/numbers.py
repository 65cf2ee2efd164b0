"""Sums and means of money kept in doubles, independent of the order in which tasks finish."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals a value may have where no other scale is given.
SCALE = 10


def exact(value: Column | str, scale: int = 2) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(f"decimal(28,{scale})")


def strict(value: Column | str, scale: int = SCALE) -> Column:
    """The value as a decimal. One with more than ``scale`` decimals, or too large, raises: it is never cut."""
    value = F.col(value) if isinstance(value, str) else value
    kept = value.try_cast(f"decimal(28,{scale})")
    told = F.concat(F.lit(f"no decimal with {scale} digits after the point: "), value.cast("string"))
    return F.when(value.isNull() | (kept.cast("double") == value.cast("double")), kept).otherwise(
        F.raise_error(told).cast(f"decimal(28,{scale})"))


def mean(value: Column | str, scale: int = SCALE) -> Column:
    """The mean of values with up to ``scale`` decimals, whatever order they come in: decimals are summed, and the sum is
    divided once. Only the caller rounds, and only the result."""
    return quotient(F.sum(strict(value, scale)), F.count(value), scale)


def quotient(total: Column, count: Column, scale: int) -> Column:
    unit = 10**scale
    return F.try_divide((total * F.lit(unit)).cast("double"), (count * F.lit(unit)).cast("double"))
