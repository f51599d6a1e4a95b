"""The register, and small helpers for results that two engines must agree on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin if it has one."""

    def add(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def long_ints(df: DataFrame) -> DataFrame:
    """INT columns as BIGINT, the integer type that the SQL twins use."""
    return df.withColumns({c: F.col(c).cast("bigint") for c, t in df.dtypes if t == "int"})


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Columns rounded, without negative zeros; :func:`round_sql` is the twin."""

    def near(value: Column) -> Column:
        return F.when(F.abs(value) < 0.5 * 10**-digits, 0.0).otherwise(F.round(value, digits))

    return df.withColumns({c: near(F.col(c)) for c in cols})


def round_sql(expression: str, name: str, digits: int = 6) -> str:
    """Twin of :func:`rounded` for one output column."""
    return (
        f"CASE WHEN abs({expression}) < 0.5e-{digits} THEN 0.0::DOUBLE "
        f"ELSE round({expression}, {digits}) END AS {name}"
    )


def exact_sum(value: str) -> str:
    """Exact sum of a column with two decimals."""
    return f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE)"


def exact_mean(value: str) -> str:
    """Exact mean of a column with two decimals."""
    return f"{exact_sum(value)} / count({value})"
