"""Exponentially weighted means of the readings before each one, over series of any length.

A reading's weight halves with every half-life that passes, in time or in readings. Weights
are powers of two, and a mean is a quotient of two running sums, ``sum(x * 2^e)`` and ``sum(2^e)``. The
exponents ``e`` count from the start of cells of ``CELL`` half-lives, so that the powers stay within
doubles. What earlier cells add is carried as one state per cell, the two sums as seen from its start. To a
state the cell before the last with readings still adds; earlier ones weigh less than ``2 ** -CELL``
of it, far below a double's precision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.functions import known, micros, width_micros
from meterlab.plans.blocks import (
    BLOCK_ROWS,
    ROWS,
    attach_table,
    over_ordered,
    running_total,
    running_totals,
)

#: Half-lives in a cell.
CELL = 400

_CELL, _W, _X, _STATE = "_cell", "_w", "_x", "_state"


def ewm_features(
    df: DataFrame,
    col: str = "power_kw",
    half_life: str | int = "6 hours",
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    out: str | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """``<col>_ewm_<half-life>``: the weighted mean of the key's readings before the current one.

    ``half_life`` is a time, or a number of known readings. The mean is that of ``adjust=True``: weights are
    divided by their sum, so it is known from the second reading on. NULL and NaN are no readings; a
    row without a time gets NULL. Of readings at equal times those before in ``order``, whose first column is the
    time, count in full.
    """
    by, order = list(by), list(order)
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    if isinstance(half_life, str):
        name = out or f"{col}_ewm_{'_'.join(half_life.split())}"
        return _weighted(
            df, value, micros(F.col(order[0])), width_micros(half_life), by, order, name, block_rows, split
        )
    if half_life < 1:
        raise ValueError(f"not a number of readings: {half_life}")
    counted = df.withColumn("_one", value.isNotNull().cast("bigint"))
    # Rows without a value hold the number of the last reading.
    numbered = running_total(counted, by, order, "_one", "_number", block_rows, split)
    name = out or f"{col}_ewm_{half_life}"
    number = F.when(F.col(order[0]).isNotNull(), F.col("_number"))
    done = _weighted(numbered, value, number, half_life, by, order, name, block_rows, split)
    return done.select(*df.columns, name)


def _weighted(
    df: DataFrame,
    value: Column,
    position: Column,
    half_life: int,
    by: Sequence[str],
    order: Sequence[str],
    out: str,
    block_rows: int,
    split: str,
) -> DataFrame:
    """Add the mean of the rows before, with weights that halve every ``half_life`` of ``position``."""
    width = F.lit(CELL * half_life)
    past = F.pmod(position, width)
    weight = F.pow(F.lit(2.0), past.cast("double") / half_life)
    placed = df.withColumn(_CELL, F.call_function("div", position - past, width)).withColumns(
        {_W: F.when(value.isNotNull(), weight), _X: value * weight}
    )
    rows = running_totals(
        placed, [*by, _CELL], order, {"_own_w": _W, "_own_x": _X}, before=True,
        block_rows=block_rows, split=split,
    )
    cells = (
        placed.where(F.col(_CELL).isNotNull())
        .groupBy(*by, _CELL)
        .agg(F.count("*").alias(ROWS), F.sum(_W).alias(_W), F.sum(_X).alias(_X))
    )
    states = _states(cells, by, block_rows, split)
    met = attach_table(rows, [*by, _CELL], states, block_rows)
    state = F.col(_STATE)
    ahead = F.pow(F.lit(2.0), F.lit(-CELL) * (F.col(_CELL) - state[_CELL]))
    added = lambda c: F.col(f"_own{c}") + F.coalesce(state[c] * ahead, F.lit(0.0))
    # Without an own reading before, however long ago the last one was, its state alone tells the mean.
    mean = F.when(F.col("_own_w").isNull(), state[_X] / state[_W]).otherwise(added(_X) / added(_W))
    return met.withColumn(out, mean).select(*df.columns, out)


def _states(cells: DataFrame, by: Sequence[str], block_rows: int, split: str) -> DataFrame:
    """For each cell the last state before it: (cell, w, x), as seen from the start of that cell."""
    held = cells.where(F.col(_W).isNotNull())
    names = [_CELL, _W, _X]

    def cell_before(series):
        return {"_before": F.lag(F.struct(*names), 1).over(series)}

    looked = over_ordered(held, by, [_CELL], cell_before, 1, names, None, block_rows, split)
    before = F.col("_before")
    apart = F.pow(F.lit(2.0), F.lit(-CELL) * (F.col(_CELL) - before[_CELL]))
    sums = [(F.col(c) + F.coalesce(before[c] * apart, F.lit(0.0))).alias(c) for c in (_W, _X)]
    after = looked.select(*by, _CELL, ROWS, F.struct(F.col(_CELL), *sums).alias("_after"))
    empty = cells.where(F.col(_W).isNull()).select(*by, _CELL, ROWS)

    def last_state(series):
        earlier = series.rowsBetween(Window.unboundedPreceding, -1)
        return {_STATE: F.last("_after", ignorenulls=True).over(earlier)}

    seen = over_ordered(
        after.unionByName(empty, allowMissingColumns=True), by, [_CELL], last_state, 1, ["_after"],
        F.col("_after").isNotNull(), block_rows, split,
    )
    return seen.select(*by, _CELL, ROWS, _STATE)
