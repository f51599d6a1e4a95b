"""Trailing statistics over wide frames, by time or by rows.

A sliding RANGE frame adds up its rows anew for each row: 86,400 steps per row
for one day of seconds. Instead time is cut into cells of the frame's own width
w. The frame ``[t - w, t)`` is then the end of the cell before t's, from t - w
on, and the start of t's own cell. Both are running aggregates, at one step per
row. Each reading goes into its own cell and, moved by w, into the next one as
history, so one shuffle brings the two together: in the cell, the frame is the
history at or after t and the own readings before t.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.functions import known, micros, width_micros
from meterlab.plans.blocks import (
    BLOCK,
    BLOCK_ROWS,
    BROADCAST_ROWS,
    ROWS,
    Hot,
    attach_table,
    carried,
    join_on,
    lay_out,
    running_total,
    split_hot,
)

TIME_STATS = ("count", "sum", "mean", "std", "min", "max")

_POS = "_position"
_CELL = "_cell"
_HISTORY = "_history"
_CARRIED = "_carried"
_FAR = 2**62
_ONE = "_one"
_NUMBER = "_number"

# The parts of a frame's state, how two states merge, and what needs which part.
_MERGE = {"_n": "sum", "_sum": "sum", "_low": "min", "_high": "max", "_s1": "sum", "_s2": "sum"}
_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}
_NEEDS = {
    "count": {"_n"},
    "sum": {"_sum"},
    "mean": {"_n", "_sum"},
    "std": {"_n", "_low", "_high"},
    "min": {"_low"},
    "max": {"_high"},
}
_MOMENTS = {"_s1", "_s2"}


def _cell(position: Column, width: int) -> Column:
    start = position - F.pmod(position, F.lit(width))
    return F.call_function("div", start, F.lit(width))


def _own_and_history(df: DataFrame, width: int, payload: Sequence[str] = ()) -> DataFrame:
    """Each row twice: in its own cell, and without its payload in the next one."""
    copies = F.array(
        F.struct(F.lit(False).alias(_HISTORY), F.col(_POS).alias(_POS)),
        F.struct(F.lit(True).alias(_HISTORY), (F.col(_POS) + width).alias(_POS)),
    )
    doubled = df.select(*[c for c in df.columns if c != _POS], F.inline(copies))
    own = {c: F.when(~F.col(_HISTORY), F.col(c)) for c in payload}
    return doubled.withColumns(own | {_CELL: _cell(F.col(_POS), width)})


def _sides(group: Sequence[str]):
    """Two functions: the aggregate of the frame's history, and of its own readings."""
    cell = Window.partitionBy(*group)
    newer = cell.orderBy(F.col(_POS).desc()).rangeBetween(Window.unboundedPreceding, 0)
    older = cell.orderBy(F.col(_POS)).rangeBetween(Window.unboundedPreceding, -1)
    old = F.col(_HISTORY)
    return (
        lambda how, value: how(F.when(old, value)).over(newer),
        lambda how, value: how(F.when(~old, value)).over(older),
    )


def _merged(rows: DataFrame, group: Sequence[str], state: Sequence[str], value: str | None):
    """Replace the state of each row by that of its frame, and add its ``_spread``.

    ``_spread`` is the sum of squares about the frame's mean. The two sides are
    merged from their means and spreads, which come from ``value`` directly or
    from ``_s1`` and ``_s2``.
    """
    history, own = _sides(group)
    zero = F.lit(0)
    columns, merged = {}, {}
    for s in state:
        columns[f"{s}_a"] = history(_AGGREGATE[_MERGE[s]], F.col(s))
        columns[f"{s}_b"] = own(_AGGREGATE[_MERGE[s]], F.col(s))
        a, b = F.col(f"{s}_a"), F.col(f"{s}_b")
        if _MERGE[s] == "sum":
            some = F.coalesce(a, b).isNotNull()
            merged[s] = F.when(some, F.coalesce(a, zero) + F.coalesce(b, zero))
        else:
            merged[s] = (F.least if _MERGE[s] == "min" else F.greatest)(a, b)
    means, spreads = [], []
    for side, aggregate in (("a", history), ("b", own)):
        n = F.col(f"_n_{side}")
        if value is not None:
            columns[f"_mean_{side}"] = aggregate(F.avg, F.col(value))
            columns[f"_var_{side}"] = aggregate(F.var_pop, F.col(value))
            means.append(F.col(f"_mean_{side}"))
            spreads.append(F.col(f"_var_{side}") * n)
        elif _MOMENTS <= set(state):
            s1, s2 = F.col(f"_s1_{side}"), F.col(f"_s2_{side}")
            means.append(F.try_divide(s1, n))
            spreads.append(F.greatest(s2 - s1 * F.try_divide(s1, n), F.lit(0.0)))
    if means:
        n_a, n_b = F.col("_n_a"), F.col("_n_b")
        apart = means[0] - means[1]
        between = apart * apart * F.try_divide(n_a * n_b, n_a + n_b)
        merged["_spread"] = reduce(
            Column.__add__, [F.coalesce(x, F.lit(0.0)) for x in (*spreads, between)]
        )
    return rows.withColumns(columns).withColumns(merged).drop(*columns)


def _statistics(prefix: str, stats: Sequence[str]) -> dict[str, Column]:
    n = F.coalesce(F.col("_n"), F.lit(0).cast("bigint"))
    constant = F.col("_low") == F.col("_high")
    deviation = F.sqrt(F.try_divide(F.col("_spread"), n - 1))
    how = {
        "count": n,
        "sum": F.col("_sum").cast("double"),
        "mean": F.try_divide(F.col("_sum").cast("double"), n),
        "std": F.when(n > 1, F.when(constant, F.lit(0.0)).otherwise(deviation)),
        "min": F.col("_low"),
        "max": F.col("_high"),
    }
    return {f"{prefix}_{s}": how[s] for s in stats}


def rolling_time(
    df: DataFrame,
    col: str = "power_kw",
    width: str = "24 hours",
    stats: Sequence[str] = TIME_STATS,
    by: Sequence[str] = ("meter_id",),
    ts: str = "ts",
    scale: int | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """``<col>_<width>_<stat>`` over the known readings in ``[ts - width, ts)``; NaN is not known.

    Rows without a time get NULL. Keys with more than ``block_rows`` rows within
    one width are worked on in blocks.
    """
    prefix = f"{col}_{'_'.join(width.split())}"
    position = micros(F.col(ts))
    return _trailing(
        df, col, position, width_micros(width), stats, prefix, by, scale, block_rows, split
    )


def rolling_many_rows(
    df: DataFrame,
    col: str,
    n: int,
    stats: Sequence[str],
    by: Sequence[str],
    order: Sequence[str],
    scale: int | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """``<col>_roll_<n>_<stat>`` of the last n readings, for large n.

    Readings are numbered within their key. The number then takes the place of
    the time: the last n readings are those numbered ``[number - n, number)``.
    """
    counted = df.withColumn(_ONE, F.lit(1).cast("bigint"))
    numbered = running_total(counted, by, order, _ONE, _NUMBER, block_rows, split).drop(_ONE)
    return _trailing(
        numbered,
        col,
        F.col(_NUMBER),
        n,
        stats,
        f"{col}_roll_{n}",
        by,
        scale,
        block_rows,
        split,
    ).drop(_NUMBER)


def _trailing(
    df: DataFrame,
    col: str,
    position: Column,
    span: int,
    stats: Sequence[str],
    prefix: str,
    by: Sequence[str],
    scale: int | None,
    block_rows: int,
    split: str,
) -> DataFrame:
    """Statistics of the rows of the key at positions ``[position - span, position)``."""
    unknown = [s for s in stats if s not in _NEEDS]
    if unknown:
        raise ValueError(f"unknown statistics: {unknown}")
    by = list(by)
    needs = set().union(*[_NEEDS[s] for s in stats])
    value = known(F.col(col), df.schema[col].dataType)
    exact = value.cast("double") if scale is None else value.cast(f"decimal(18,{scale})")
    single = {
        "_n": F.when(value.isNotNull(), F.lit(1).cast("bigint")),
        "_sum": exact,
        "_low": value,
        "_high": value,
    }
    single = {s: c for s, c in single.items() if s in needs}
    result = _statistics(prefix, stats)

    def short(rows: DataFrame) -> DataFrame:
        plain = single | {"_value": value.cast("double")}
        placed = rows.withColumns({_POS: position} | plain)
        payload = [c for c in rows.columns if c not in by]
        doubled = _own_and_history(placed, span, payload)
        framed = _merged(
            doubled, [*by, _CELL], list(single), "_value" if "std" in stats else None
        ).where(~F.col(_HISTORY))
        placed = F.col(_POS).isNotNull()
        return framed.withColumns({c: F.when(placed, v) for c, v in result.items()}).select(
            *rows.columns, *result
        )

    def long(hot: Hot) -> DataFrame:
        placed = hot.df.withColumn(_POS, position)
        rows, parts = placed.where(F.col(_POS).isNotNull()), dict(single)
        if "std" in stats:
            # Squares are added up about the mean of the key, else large values
            # with a small spread would cancel out.
            if by:
                means = rows.groupBy(*by).agg(F.avg(value).alias("_centre"))
                means = F.broadcast(means) if hot.keys <= BROADCAST_ROWS else means
                rows = join_on(rows, means, by)
            else:
                rows = rows.withColumn("_centre", rows.agg(F.avg(value)).scalar())
            away = value.cast("double") - F.col("_centre")
            parts |= {"_s1": away, "_s2": away * away}
        state, group = list(parts), [*by, _CELL]
        # One row per position, so that no two rows of a cell tie.
        instants = (
            rows.select(*by, _POS, *[c.alias(s) for s, c in parts.items()])
            .groupBy(*by, _POS)
            .agg(F.count("*").alias(ROWS), *[_AGGREGATE[_MERGE[s]](s).alias(s) for s in state])
        )
        doubled = _own_and_history(instants, span)
        laid = lay_out(doubled, 2 * hot.rows, group, [_POS, _HISTORY], block_rows)
        together = laid.withColumn(_CARRIED, F.lit(False))
        # Own readings of earlier blocks count as one reading before all others
        # of the block, history of later blocks as one after all others.
        for history, end in ((False, -_FAR), (True, _FAR)):
            side = F.col(_HISTORY) if history else ~F.col(_HISTORY)
            masked = laid.withColumns({s: F.when(side, F.col(s)) for s in state})
            copies = carried(masked, group, {s: _MERGE[s] for s in state}, forward=not history)
            copies = copies.withColumns(
                {_HISTORY: F.lit(history), _POS: F.lit(end), _CARRIED: F.lit(True)}
            )
            together = together.unionByName(copies, allowMissingColumns=True)
        framed = _merged(together, [*group, BLOCK], state, None).where(
            ~F.col(_HISTORY) & ~F.col(_CARRIED)
        )
        framed = framed.select(*by, _POS, ROWS, *[v.alias(c) for c, v in result.items()])
        return attach_table(placed, [*by, _POS], framed, block_rows).drop(_POS)

    if split == "never":
        return short(df)
    light, hot = split_hot(df, by, block_rows, within={_CELL: _cell(position, span)})
    parts = [] if light is None else [short(light)]
    if hot is not None:
        parts.append(long(hot))
    return reduce(DataFrame.unionByName, parts)
