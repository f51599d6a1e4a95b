"""Time features of single readings.

Names say what they measure: ``lag_1`` is the previous *reading*; values of an
earlier *hour* come from :mod:`meterlab.operators.grid`. Trailing statistics
leave the current reading out, so they are known when it is forecast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.functions import known, seconds_between
from meterlab.operators.trailing import rolling_many_rows
from meterlab.plans.blocks import BLOCK_ROWS, over_ordered, running_total

CALENDAR_PARTS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "weekday": F.weekday,
    "day_of_year": F.dayofyear,
    "week": F.weekofyear,
}
# part -> (length of the cycle, first value)
_CYCLES = {"hour": (24, 0), "weekday": (7, 0), "month": (12, 1), "minute": (60, 0)}
ROLLING_STATS = ("mean", "std", "min", "max")  # the default; count and sum are accepted too
# A sliding frame adds up its rows anew for each row; wider ones are built otherwise.
SLIDING_ROWS = 256
# Lags beyond this part of a block are matched by number.
FAR_PART = 4


def calendar_features(
    df: DataFrame, ts: str = "ts", parts: Sequence[str] = tuple(CALENDAR_PARTS)
) -> DataFrame:
    """One column per calendar part; weekday counts from Monday = 0, week is the ISO week."""
    return df.withColumns({p: CALENDAR_PARTS[p](F.col(ts)) for p in parts})


def calendar_flags(df: DataFrame, ts: str = "ts") -> DataFrame:
    """``is_weekend`` (0 / 1) and ``day_part``."""
    hour = F.hour(ts)
    return df.withColumns(
        {
            "is_weekend": F.when(F.weekday(F.col(ts)) >= 5, 1)
            .when(F.col(ts).isNotNull(), 0),
            "day_part": F.when(hour < 6, "night")
            .when(hour < 12, "morning")
            .when(hour < 18, "afternoon")
            .when(hour < 24, "evening"),
        }
    )


def cyclic_features(
    df: DataFrame, parts: Sequence[str] = ("hour", "weekday", "month"), ts: str = "ts"
) -> DataFrame:
    """Sine and cosine of calendar parts, so that 23 h lies next to 0 h."""
    columns = {}
    for part in parts:
        length, first = _CYCLES[part]
        angle = F.lit(2 * math.pi) * (CALENDAR_PARTS[part](F.col(ts)) - first) / length
        columns[f"{part}_sin"] = F.sin(angle)
        columns[f"{part}_cos"] = F.cos(angle)
    return df.withColumns(columns)


def _lag_columns(series, col: str, lags: Sequence[int]) -> dict[str, Column]:
    return {f"{col}_lag_{n}": F.lag(col, n).over(series) for n in lags}


def _rolling_columns(
    series, col: str, value: Column, n: int, stats: Sequence[str], scale: int | None
) -> dict[str, Column]:
    frame = series.rowsBetween(-n, -1)
    added = value.cast("double") if scale is None else value.cast(f"decimal(18,{scale})")
    sums, count = F.sum(added).over(frame).cast("double"), F.count(value).over(frame)
    how = {
        "count": count,
        "sum": sums,
        "mean": F.try_divide(sums, count),
        "std": F.stddev_samp(value).over(frame),
        "min": F.min(value).over(frame),
        "max": F.max(value).over(frame),
    }
    return {f"{col}_roll_{n}_{s}": how[s] for s in stats}


def _delta_columns(series, col: str, ts: str) -> dict[str, Column]:
    """The change, and the time of the previous reading in the place of the seconds since."""
    return {
        f"{col}_delta": F.col(col) - F.lag(col, 1).over(series),
        "seconds_since_previous": F.lag(ts, 1).over(series),
    }


def _far_lags(
    df: DataFrame,
    col: str,
    lags: Sequence[int],
    by: Sequence[str],
    order: Sequence[str],
    block_rows: int,
    split: str,
) -> DataFrame:
    """``<col>_lag_<n>`` for large n: each row offers its value to the row n later, by number.

    Rows and offers meet in one shuffle, in groups of one row and one offer per lag, so the
    cost does not depend on n.
    """
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_total(counted, by, order, "_one", "_number", block_rows, split)
    ends = [(0, F.col("_number")), *[(n, F.col("_number") + n) for n in lags]]
    both = F.array(*[F.struct(F.lit(n).alias("_lag"), at.alias("_at")) for n, at in ends])
    unfolded = numbered.select(*df.columns, F.inline(both))
    own = {c: F.when(F.col("_lag") == 0, F.col(c)) for c in df.columns if c not in (*by, col)}
    met = Window.partitionBy(*by, "_at")
    offers = {
        f"{col}_lag_{n}": F.first(F.when(F.col("_lag") == n, F.col(col)), ignorenulls=True).over(met) for n in lags
    }
    return unfolded.withColumns(own).withColumns(offers).where("_lag = 0").select(*df.columns, *offers)


def history_features(
    df: DataFrame,
    col: str = "power_kw",
    lags: Sequence[int] = (1,),
    rolling: Sequence[int] = (),
    stats: Sequence[str] = ROLLING_STATS,
    delta: bool = False,
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    scale: int | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Lags, trailing row statistics and change together: one shuffle and one sort for all.

    New columns come in the order of lags, trailing statistics as given, change.
    NaN counts as missing in trailing statistics. Those of more than ``SLIDING_ROWS`` rows take steps of their own;
    they are the same but for the last bits of sums, which are added up in another order.
    """
    given = list(df.columns)
    many = [n for n in rolling if n > SLIDING_ROWS]
    for n in many:
        df = rolling_many_rows(df, col, n, stats, by, order, scale, block_rows, split)
    few = [n for n in rolling if n <= SLIDING_ROWS]
    # Blocks get copies of as many rows as the longest lag; far ones would double the blocks.
    far = [n for n in lags if n > block_rows // FAR_PART] if split != "never" else []
    if far:
        df = _far_lags(df, col, far, by, order, block_rows, split)
    near = [n for n in lags if n not in far]
    if not (near or few or delta):
        return df if not (far and many) else df.select(*given, *_history_names(col, lags, rolling, stats))

    value = known(F.col(col), df.schema[col].dataType)

    def build(series) -> Mapping[str, Column]:
        columns = _lag_columns(series, col, near)
        for n in few:
            columns.update(_rolling_columns(series, col, value, n, stats, scale))
        if delta:
            columns.update(_delta_columns(series, col, order[0]))
        return columns

    reach = max([*near, *few, 1 if delta else 0])
    out = over_ordered(
        df, by, order, build, reach=reach, cols=[col], block_rows=block_rows, split=split
    )
    if delta:
        # From a column, since the seconds look at the time several times.
        since = seconds_between(F.col("seconds_since_previous"), F.col(order[0]))
        out = out.withColumn("seconds_since_previous", since)
    if not many and not far:
        return out
    return out.select(*given, *_history_names(col, lags, rolling, stats), *([f"{col}_delta", "seconds_since_previous"] if delta else []))


def _history_names(col: str, lags: Sequence[int], rolling: Sequence[int], stats: Sequence[str]) -> list[str]:
    return [f"{col}_lag_{n}" for n in lags] + [f"{col}_roll_{n}_{s}" for n in rolling for s in stats]


def lag_features(
    df: DataFrame,
    col: str = "power_kw",
    lags: Sequence[int] = (1,),
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """``<col>_lag_<n>``: the reading n rows earlier."""
    return history_features(
        df, col, lags=lags, by=by, order=order, block_rows=block_rows, split=split
    )


def rolling_rows(
    df: DataFrame,
    col: str = "power_kw",
    n: int = 3,
    stats: Sequence[str] = ROLLING_STATS,
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    scale: int | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """``<col>_roll_<n>_<stat>`` of the last n readings, the current one left out."""
    return history_features(
        df, col, (), [n], stats, by=by, order=order, scale=scale,
        block_rows=block_rows, split=split,
    )


def delta_features(
    df: DataFrame,
    col: str = "power_kw",
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Change since the previous reading, and the whole seconds since it."""
    return history_features(
        df, col, (), delta=True, by=by, order=order, block_rows=block_rows, split=split
    )
