"""Sums, means and number parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def total(value: Column, scale: int | None = None) -> Column:
    """Sum as DOUBLE.

    Double sums depend on the order of the rows. Where the data has a known
    number of decimals, ``scale`` adds them up exactly as DECIMAL(18, scale).
    """
    if scale is None:
        return F.sum(value.cast("double"))
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def mean(value: Column, scale: int | None = None) -> Column:
    """Mean of the known values as DOUBLE, with an exact sum if ``scale`` is given."""
    if scale is None:
        return F.avg(value.cast("double"))
    return F.try_divide(total(value, scale), F.count(value))


def known(value: Column, dtype: DataType) -> Column:
    """The value with NaN as NULL."""
    if isinstance(dtype, (FloatType, DoubleType)):
        return F.nanvl(value, F.lit(None).cast(dtype))
    return value


def not_a_number(value: Column, dtype: DataType) -> Column:
    """True where a floating-point column holds NaN; false for every other type."""
    if isinstance(dtype, (FloatType, DoubleType)):
        return F.coalesce(F.isnan(value), F.lit(False))
    return F.lit(False)


def number(text: Column, dtype: str = "double") -> Column:
    """Text to number; anything else gives NULL.

    Casting alone would let ``5d`` through as 5.0, and ``NaN``, ``Infinity`` and
    numbers too large for the type as values that are not finite.
    """
    value = text.try_cast(dtype)
    if dtype in ("double", "float"):
        suffixed = text.rlike(r"[dDfF]\s*$")
        return F.when(~suffixed & ~F.isnan(value) & (F.abs(value) < float("inf")), value)
    return value
