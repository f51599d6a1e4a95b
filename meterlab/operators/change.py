"""Change points and seasonal parts of series of any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from meterlab.functions import is_fixed_width, known, micros, width_micros
from meterlab.operators.features import rolling_rows
from meterlab.operators.grid import direct_label
from meterlab.plans.blocks import (
    BLOCK_ROWS,
    BROADCAST_ROWS,
    ROWS,
    attach_table,
    join_on,
    over_ordered,
    running_totals,
    settle,
)

_PENALTY = 10.0
# Median distance of two draws from a normal distribution of variance 1.
_MEDIAN = 0.9538725524


def change_points(
    df: DataFrame,
    col: str = "power_kw",
    by: Sequence[str] = ("meter_id",),
    order: Sequence[str] = ("ts",),
    penalty: float = _PENALTY,
    least_rows: int = 5,
    most_rounds: int = 30,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """The times at which the level of a key's known readings shifts: (*by, time, ``mean_before``, ``mean_after``).

    Binary segmentation: in each round every segment is split where that lowers its sum of squares most, if by more
    than ``penalty`` times the logarithm of the key's rows times its noise. That is the variance which the median
    distance of neighbours would have under a normal distribution, so shifts themselves hardly count, and at least
    ``1e-9`` of the key's variance, beyond rounding. Parts have ``least_rows`` at least. It ends when no segment is split, and an
    error says so if that takes more than ``most_rounds``. The time is that of the first reading of the new
    level; its means are those of the last segments on both sides.

    Sums so far are computed once, over blocks; each round is one pre-aggregated grouping of all segments
    of all keys, so a long series spreads. Readings without a time do not count.
    """
    by, order = list(by), list(order)
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    held = df.where(F.col(order[0]).isNotNull()).select(*by, *order, value.alias("_x")).where(F.col("_x").isNotNull())

    def before(series):
        return {"_last": F.lag("_x", 1).over(series)}

    looked = over_ordered(held, by, order, before, 1, ["_x"], None, block_rows, split)
    middle = F.percentile_approx(F.abs(F.col("_x") - F.col("_last")), 0.5, 10_000)
    noise = F.greatest(F.pow(middle / _MEDIAN, 2), 1e-9 * F.var_pop("_x"))
    keys = looked.groupBy(*by).agg(F.count("*").alias(ROWS), F.avg("_x").alias("_centre"), noise.alias("_noise"))
    keys = keys.withColumn("_rows_of_key", F.col(ROWS))
    near = attach_table(held, by, keys, block_rows)
    # Sums about the mean of the key, else large levels would hide small shifts.
    near = near.withColumns({"_x": F.col("_x") - F.col("_centre"), "_one": F.lit(1).cast("bigint")})
    summed = running_totals(near, by, order, {"_n": "_one", "_s": "_x"}, block_rows=block_rows, split=split)
    least = penalty * F.log("_rows_of_key") * F.col("_noise")
    rows = settle(summed.select(*by, order[0], "_n", "_s", "_centre", least.alias("_least"), F.lit(0).cast("bigint").alias("_from"), F.lit(0.0).alias("_s0")), "sums-so-far")

    segment = [*by, "_from"]
    done = None
    for _ in range(most_rounds):
        totals = rows.groupBy(*segment, "_s0").agg(F.max(F.struct("_n", "_s")).alias("_end"))
        totals = settle(totals, "segments")
        # A segment that was not split in the round before would not be now.
        open_ = totals if done is None else join_on(totals, done, segment, "left_anti")
        few = F.broadcast(open_) if open_.count() <= BROADCAST_ROWS else open_
        inside = join_on(rows, few.select(*segment, "_end"), segment, "inner")
        n, s = F.col("_n") - F.col("_from"), F.col("_s") - F.col("_s0")
        m, t = F.col("_end._n") - F.col("_n"), F.col("_end._s") - F.col("_s")
        gain = s * s / n + t * t / m - (s + t) * (s + t) / (n + m)
        possible = inside.where((n >= least_rows) & (m >= least_rows)).withColumn("_gain", gain).where("_gain > _least")
        # Ties go to the earlier reading.
        best = F.max_by(F.struct("_n", "_s"), F.struct(F.col("_gain"), -F.col("_n")))
        cuts = settle(possible.groupBy(*segment).agg(best.alias("_cut")), "cuts")
        count = cuts.count()
        if not count:
            break
        done = settle(join_on(totals.select(*segment), cuts.select(*segment), segment, "left_anti"), "done")
        cuts = F.broadcast(cuts) if count <= BROADCAST_ROWS else cuts
        cut = F.col("_n") > F.col("_cut._n")
        moved = join_on(rows, cuts, segment)
        rows = settle(
            moved.withColumns(
                {
                    "_from": F.when(cut, F.col("_cut._n")).otherwise(F.col("_from")),
                    "_s0": F.when(cut, F.col("_cut._s")).otherwise(F.col("_s0")),
                }
            ).drop("_cut"),
            "cut-rows",
        )
    else:
        raise RuntimeError(f"segments are still split after {most_rounds} rounds")
    first = rows.groupBy(*segment, "_s0", "_centre").agg(
        F.min(F.struct("_n", order[0]))[order[0]].alias(order[0]), F.max(F.struct("_n", "_s")).alias("_end")
    )
    mean = (F.col("_end._s") - F.col("_s0")) / (F.col("_end._n") - F.col("_from")) + F.col("_centre")
    levels = settle(first.select(*by, "_from", order[0], mean.alias("mean_after")), "levels")

    def level_before(series):
        return {"mean_before": F.lag("mean_after", 1).over(series)}

    found = over_ordered(levels, by, ["_from"], level_before, 1, ["mean_after"], None, block_rows, split)
    return found.where("_from > 0").select(*by, order[0], "mean_before", "mean_after")


def decompose(
    df: DataFrame,
    col: str,
    period: int = 24,
    step: str = "hour",
    by: Sequence[str] = ("meter_id",),
    ts: str = "bucket",
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Add ``<col>_trend``, ``<col>_season`` and ``<col>_rest`` of a regular grid; they add up to the value.

    The trend is the centred mean over one period of ``period`` steps, with half weights at both ends if that is
    even; it is NULL within half a period of the ends, as is the rest. The season is the mean distance from
    the trend at the same phase, less the mean of all phases of the key. NULL values, as empty steps have, count in no mean.

    A centred frame is a trailing one looked at later: trailing means are computed over blocks, and meet
    the steps they are centred on by their time, in one shuffle.
    """
    if period < 2 or not is_fixed_width(step):
        raise ValueError("a period has two steps or more, of fixed length")
    by, half = list(by), period // 2
    value = known(F.col(col), df.schema[col].dataType).cast("double")
    plain = df.withColumn(col, value)
    name = f"{col}_roll_{period}_mean"
    trailing = rolling_rows(plain, col, period, ("mean",), by, (ts,), block_rows=block_rows, split=split)
    # The first rows have no whole period before them.
    def first_rows(series):
        return {"_whole": F.lag(ts, period).over(series)}

    whole = over_ordered(trailing, by, [ts], first_rows, period, [ts], None, block_rows, split)
    whole = whole.withColumn(name, F.when(F.col("_whole").isNotNull(), F.col(name))).drop("_whole")
    ahead = half + (1 if period % 2 else 0)
    met = direct_label(whole, name, ahead, step, by, ts, "_a", unique=True)
    if period % 2:
        trend = F.col("_a")
    else:
        met = direct_label(met, name, ahead + 1, step, by, ts, "_b", unique=True)
        trend = (F.col("_a") + F.col("_b")) / 2
    phase = F.pmod(F.call_function("div", micros(F.col(ts)), F.lit(width_micros(step))), F.lit(period))
    parts = settle(met.withColumns({f"{col}_trend": trend, "_phase": phase}).select(*df.columns, f"{col}_trend", "_phase"), "trend")
    away = F.avg(F.col(col) - F.col(f"{col}_trend"))
    phases = settle(parts.groupBy(*by, "_phase").agg(F.count("*").alias(ROWS), away.alias("_away")), "phases")
    means = phases.groupBy(*by).agg(F.avg("_away").alias("_mean"))
    seasons = join_on(phases, means, by).select(*by, "_phase", ROWS, (F.col("_away") - F.col("_mean")).alias(f"{col}_season"))
    found = attach_table(parts, [*by, "_phase"], seasons, block_rows)
    rest = F.col(col) - F.col(f"{col}_trend") - F.col(f"{col}_season")
    return found.withColumn(f"{col}_rest", rest).select(
        *df.columns, f"{col}_trend", f"{col}_season", f"{col}_rest"
    )
