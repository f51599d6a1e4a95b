"""As-of joins: to each row the last row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from meterlab.functions import micros, width_micros
from meterlab.plans.blocks import BLOCK_ROWS, over_ordered

_AT = "_at"
_SIDE = "_side"
_RANK = "_rank"
_OTHER = "_other"


def asof_join(
    df: DataFrame,
    other: DataFrame,
    by: Sequence[str] = ("meter_id",),
    ts: str = "ts",
    cols: Sequence[str] | None = None,
    order: Sequence[str] = (),
    tolerance: str | None = None,
    direction: str = "backward",
    exact: bool = True,
    suffix: str = "_asof",
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Add the columns ``cols`` of the row of ``other`` that was in force at each row's time.

    That is the last row of the same key at or before the time (``direction="forward"``:
    the first at or after it), no further away than ``tolerance``; ``exact=False`` leaves
    out rows at the very time. New columns, also the time of that row, end with ``suffix``.
    Of rows of ``other`` with equal key and time the last by ``order``, and by all ``cols``, counts.
    Rows without a match, and those without a time, get NULL; rows of ``other`` without a time
    match nothing. NULL keys match, as they do in PARTITION BY. ``by=()`` joins by time alone, for
    example tariffs that hold for all meters.

    Both tables are laid out in one series per key, and each row looks back at the last row of the
    other kind. So a join costs one shuffle of both, not pairs of rows; long series go in blocks.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction: {direction!r}")
    by = list(by)
    chosen = [c for c in other.columns if c not in by] if cols is None else [*dict.fromkeys([ts, *cols])]
    added = [f"{c}{suffix}" for c in chosen]
    clashing = sorted(set(added) & set(df.columns))
    if clashing:
        raise ValueError(f"columns exist already: {clashing}")
    sign = 1 if direction == "backward" else -1
    # At equal times the side that sorts first is seen by the other.
    mine, theirs = (1, 0) if exact else (0, 1)
    names = {c: f"_{i}" for i, c in enumerate(df.columns)}
    rows = df.select(
        *[F.col(c).alias(c if c in by else names[c]) for c in df.columns],
        (micros(F.col(ts)) * sign).alias(_AT),
        F.lit(mine).alias(_SIDE),
    )
    offered = other.where(F.col(ts).isNotNull()).select(
        *by,
        (micros(F.col(ts)) * sign).alias(_AT),
        F.lit(theirs).alias(_SIDE),
        F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate([*order, *chosen])]).alias(_RANK),
        F.struct(*[F.col(c).alias(name) for c, name in zip(chosen, added, strict=True)]).alias(_OTHER),
    )

    def in_force(series):
        so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {"_found": F.last(_OTHER, ignorenulls=True).over(so_far)}

    met = over_ordered(
        rows.unionByName(offered, allowMissingColumns=True),
        by,
        [_AT, _SIDE, _RANK],
        in_force,
        reach=1,
        cols=[_OTHER],
        keep=F.col(_OTHER).isNotNull(),
        block_rows=block_rows,
        split=split,
    ).where(F.col(_SIDE) == mine)
    found = F.when(F.col(_AT).isNotNull(), F.col("_found"))
    if tolerance is not None:
        away = F.abs(F.col(_AT) - sign * micros(F.col("_found")[f"{ts}{suffix}"]))
        found = F.when(away <= width_micros(tolerance), found)
    return met.withColumn("_found", found).select(
        *[F.col(c if c in by else names[c]).alias(c) for c in df.columns],
        *[F.col("_found")[name].alias(name) for name in added],
    )
