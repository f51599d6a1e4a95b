"""Ordered work on series of any length.

``PARTITION BY meter ORDER BY ts`` puts a whole meter into one task. That is
right for many short series and fails for one that holds a third of all rows.
So operators that need the order of a series come here:

* Keys with at most ``block_rows`` rows use the plain window.
* Longer series are range-partitioned by (key, order), and each range is cut into
  *blocks* of ``block_rows`` rows, whatever the distribution of keys and times. Each block
  gets a copy of the little it needs from its neighbours: the last ``reach``
  rows before it, or the running totals so far. The same window, now inside
  (key, block), then gives the same result.

Blocks are read by more than one branch of the plan, and a second evaluation of
the range partitioning could draw other limits. They are therefore written, as
Parquet, to the checkpoint folder that the executors share before anything reads
them. Each branch then scans only its columns, and losing an executor costs no
more than the tasks it ran.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextvars import ContextVar
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

BLOCK_ROWS = 1_000_000
# Pieces of a series whose running totals one task adds up; see :func:`carried`.
PIECES = 4_096
# Tables of one short row per key are broadcast up to this many rows.
BROADCAST_ROWS = 100_000

BLOCK = "_block"
TIE = "_tie"
ROWS = "_rows"
_COPY = "_copy"
_POS = "_pos"


class Hot(NamedTuple):
    """The rows of the long series, how many they are, and of how many keys."""

    df: DataFrame
    rows: int
    keys: int


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The application's own folder for checkpoints, below the shared folder that the session names.

    Without the setting only local mode may start, where all tasks share the machine's folders.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = f"{tempfile.gettempdir()}/meterlab"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that lives as long as a job."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it from there: computed once, no lineage.

    Such tables stay until :func:`clear_scratch`, since results that are not yet
    computed may still read them, or until the :func:`settled` ends in which they were written.
    """
    path = scratch_path(df.sparkSession, name)
    for held in _SCOPES.get():
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Paths written in the scopes that are open, the innermost last; threads have their own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


def settled(df: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table that ``df`` builds, stored; what was stored on the way to it is deleted."""
    held: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), held))
    try:
        stored = settle(df(), name)
    finally:
        _SCOPES.reset(token)
    _delete(stored.sparkSession, held[:-1])
    return stored


def _delete(spark: SparkSession, paths: Sequence[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's intermediate tables; call it when all results are written."""
    _delete(spark, [ensure_checkpoint_dir(spark)])


def join_on(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match, as they do in GROUP BY and PARTITION BY."""
    hidden = {c: f"_right_{c}" for c in by}
    right = right.withColumnsRenamed(hidden)
    condition = reduce(
        Column.__and__, [F.col(c).eqNullSafe(F.col(name)) for c, name in hidden.items()]
    )
    return left.join(right, condition, how).drop(*hidden.values())


def has_group_above(df: DataFrame, by: Sequence[str], rows: int) -> bool:
    """Whether some group has more than so many rows."""
    return not df.groupBy(*by).count().where(F.col("count") > rows).isEmpty()


def split_hot(
    df: DataFrame,
    by: Sequence[str],
    block_rows: int,
    within: Mapping[str, Column] | None = None,
) -> tuple[DataFrame | None, Hot | None]:
    """Part the rows into those of short and those of long series.

    A key is long if it has more than ``block_rows`` rows, or more than that in
    one of the groups that ``within`` cuts it into. Counting reads only the key
    columns and is aggregated before its shuffle. There are fewer than
    rows / block_rows long keys; up to ``BROADCAST_ROWS`` of them are broadcast,
    more are joined by shuffle.
    """
    by = list(by)
    keyed = df.withColumns(dict(within)) if within else df
    groups = keyed.groupBy(*by, *(within or {})).agg(F.count("*").alias(ROWS))
    keys = (
        groups.groupBy(*by)
        .agg(F.sum(ROWS).alias(ROWS), F.max(ROWS).alias("_most"))
        .where(F.col("_most") > block_rows)
        if within
        else groups.where(F.col(ROWS) > block_rows)
    )
    found = keys.agg(F.count("*").alias("keys"), F.sum(ROWS).alias("rows")).first()
    if not found.keys:
        return df, None
    if not by:
        return None, Hot(df, found.rows, 1)
    hot_keys = settle(keys.select(*by), "hot-keys")
    if found.keys <= BROADCAST_ROWS:
        hot_keys = F.broadcast(hot_keys)
    light = join_on(df, hot_keys, by, "left_anti")
    return light, Hot(join_on(df, hot_keys, by, "left_semi"), found.rows, found.keys)


def attach(
    df: DataFrame, by: Sequence[str], *aggs: Column, of: DataFrame | None = None
) -> DataFrame:
    """Add to each row the aggregates of its key, taken from ``of`` (or ``df`` itself)."""
    source = df if of is None else of
    return attach_table(df, by, source.groupBy(*by).agg(F.count("*").alias(ROWS), *aggs))


def attach_table(
    df: DataFrame, by: Sequence[str], table: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Left join with a table of one row per key, whose ``ROWS`` says how many rows the key has.

    The table is computed once and stored. Few keys are broadcast, so that the
    rows need no shuffle. Otherwise the keys with the most rows are, and only the
    rows of the other keys are shuffled.
    """
    by = list(by)
    table = settle(table, "per-key")
    facts = table.drop(ROWS)
    if table.count() <= BROADCAST_ROWS:
        return join_on(df, F.broadcast(facts), by)
    hot = table.where(F.col(ROWS) > block_rows).drop(ROWS)
    if not 0 < hot.count() <= BROADCAST_ROWS:
        return join_on(df, facts, by)
    hot = F.broadcast(hot)
    cool = join_on(join_on(df, hot.select(*by), by, "left_anti"), facts, by)
    return cool.unionByName(join_on(df, hot, by, "inner"))


def lay_out(
    df: DataFrame, rows: int, by: Sequence[str], order: Sequence[str], block_rows: int
) -> DataFrame:
    """The ``rows`` rows of ``df`` with their block number; blocks ascend with (by, order).

    Ranges are as many as the session has shuffle partitions, more if one would hold over
    ``BLOCK_ROWS`` rows; a task sorts its range and cuts it into blocks of ``block_rows``.
    So the number of tasks and files does not grow with that of blocks. ``TIE`` numbers the
    rows as they were laid, which fixes the sequence of those that tie.
    """
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = min(rows // block_rows + 1, max(rows // BLOCK_ROWS + 1, shuffles))
    # monotonically_increasing_id: the task's number above, and its rows' numbers in 33 bits.
    task, place = F.shiftright(TIE, 33), F.col(TIE).bitwiseAND(F.lit(2**33 - 1))

    def cut(numbered: DataFrame) -> DataFrame:
        ranged = numbered.repartitionByRange(n_ranges, *by, *order, TIE)
        laid = ranged.sortWithinPartitions(*by, *order, TIE).withColumn(TIE, F.monotonically_increasing_id())
        block = F.shiftleft(task, 33) + F.call_function("div", place, F.lit(block_rows))
        return settle(laid.withColumn(BLOCK, block), "blocks")

    laid = cut(df.withColumn(TIE, F.lit(0).cast("bigint")))
    most = laid.groupBy(task).count().agg(F.max("count")).first()[0] or 0
    if most > 4 * max(block_rows, rows // n_ranges):
        # Rows that agree on (by, order) cannot be told apart by a range. Now
        # that they are stored their sequence is fixed and numbered: cut again.
        laid = cut(laid.drop(BLOCK))
    return laid


def _rows_before(
    laid: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    reach: int,
    keep: Column | None,
) -> DataFrame:
    """For each piece (by, block): copies of the last ``reach`` rows before it.

    Only the last rows of each piece are gathered, at most ``reach`` per piece,
    and cutting ranges into blocks makes hardly more pieces than blocks.
    """
    by, order = list(by), [*order, TIE]
    kept = laid if keep is None else laid.where(keep)
    newest = Window.partitionBy(*by, BLOCK).orderBy(*[F.col(c).desc() for c in order])
    ends = (
        kept.select(*by, BLOCK, *order, *[c for c in cols if c not in (*by, *order)])
        .withColumn("_age", F.row_number().over(newest))
        .where(F.col("_age") <= reach)
    )
    held = F.count("*") if keep is None else F.count_if(keep)
    pieces = laid.groupBy(*by, BLOCK).agg(F.least(held, F.lit(reach)).cast("bigint").alias("_held"))
    pieces = settle(carried(pieces, by, {"_held": "sum"}, keep_own=True), "pieces")
    # A kept row's number in its series: those of earlier pieces, and its own from the start
    # of its piece, which its age tells. So no window runs over the rows of a whole series.
    until = F.coalesce(F.col("_held"), F.lit(0)) + F.col("_own__held")
    numbered = (
        join_on(ends, pieces.select(*by, BLOCK, until.alias("_until")), [*by, BLOCK], "inner")
        .withColumn(_POS, (F.col("_until") - F.col("_age") + 1).cast("bigint"))
        .drop(BLOCK, "_until", "_age")
    )
    wanted = (
        pieces.select(*by, BLOCK, F.col("_held").alias("_last"))
        .where(F.col("_last") > 0)
        .withColumn("_first", F.greatest(F.col("_last") - reach + 1, F.lit(1)))
        .select(*by, BLOCK, F.explode(F.sequence("_first", "_last")).alias(_POS))
    )
    return join_on(wanted, numbered, [*by, _POS], "inner").drop(_POS)


def over_ordered(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], Mapping[str, Column]],
    reach: int,
    cols: Sequence[str],
    keep: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Add the columns ``build(window)`` for the ordered series of each key.

    ``build`` may look at the current row and at the ``reach`` rows before it
    (with ``keep``: those before it for which ``keep`` holds), and only at
    ``by``, ``order`` and ``cols``. ``split="never"`` promises that no key has
    more than ``block_rows`` rows and saves the count.
    """
    by, order = list(by), list(order)
    plain = Window.partitionBy(*by).orderBy(*order)
    if split == "never":
        return df.withColumns(dict(build(plain)))
    light, hot = split_hot(df, by, block_rows)
    if hot is None:
        return df.withColumns(dict(build(plain)))
    laid = lay_out(hot.df, hot.rows, by, order, block_rows)
    copies = _rows_before(laid, by, order, cols, reach, keep).withColumn(_COPY, F.lit(True))
    inside = Window.partitionBy(*by, BLOCK).orderBy(*order, TIE)
    blocked = (
        laid.withColumn(_COPY, F.lit(False))
        .unionByName(copies, allowMissingColumns=True)
        .withColumns(dict(build(inside)))
        .where(~F.col(_COPY))
        .drop(_COPY, BLOCK, TIE)
    )
    if light is None:
        return blocked
    return light.withColumns(dict(build(plain))).unionByName(blocked)


def carried(
    laid: DataFrame,
    by: Sequence[str],
    merge: Mapping[str, str],
    forward: bool = True,
    keep_own: bool = False,
) -> DataFrame:
    """For each piece (by, block): the merged ``merge`` columns of all pieces before it.

    ``merge`` maps a column to ``"sum"``, ``"min"`` or ``"max"``. With
    ``forward=False`` the pieces after it are merged; ``keep_own`` adds the piece's
    own value as ``_own_<column>``. Pieces are aggregated before any shuffle and
    merged on two levels: inside runs of ``PIECES`` blocks, and over one row per run.
    """
    by = list(by)
    run = "_run"
    step = F.col(BLOCK) if forward else F.col(BLOCK).desc()
    turn = F.col(run) if forward else F.col(run).desc()
    in_run = Window.partitionBy(*by, run).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    runs_before = Window.partitionBy(*by).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    how = {"sum": F.sum, "min": F.min, "max": F.max}

    def both(kind: str, a: Column, b: Column) -> Column:
        if kind == "sum":
            return F.coalesce(a + b, a, b)
        return F.least(a, b) if kind == "min" else F.greatest(a, b)

    pieces = (
        laid.groupBy(*by, BLOCK)
        .agg(*[how[m](c).alias(c) for c, m in merge.items()])
        .withColumn(run, F.floor(F.col(BLOCK) / F.lit(PIECES)))
    )
    earlier = pieces.groupBy(*by, run).agg(*[how[m](c).alias(c) for c, m in merge.items()])
    earlier = earlier.select(
        *by, run, *[how[m](c).over(runs_before).alias(f"_runs_{c}") for c, m in merge.items()]
    )
    inside = pieces.select(
        *by,
        run,
        BLOCK,
        *[how[m](c).over(in_run).alias(f"_in_{c}") for c, m in merge.items()],
        *[F.col(c).alias(f"_own_{c}") for c in merge],
    )
    own = [f"_own_{c}" for c in merge] if keep_own else []
    return join_on(inside, earlier, [*by, run]).select(
        *by,
        BLOCK,
        *own,
        *[both(m, F.col(f"_in_{c}"), F.col(f"_runs_{c}")).alias(c) for c, m in merge.items()],
    )


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    col: str,
    out: str,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Cumulative sum of ``col`` in the order of ``order``, current row included."""
    return running_totals(df, by, order, {out: col}, block_rows=block_rows, split=split)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, str],
    before: bool = False,
    block_rows: int = BLOCK_ROWS,
    split: str = "auto",
) -> DataFrame:
    """Cumulative sums ``{out: column}`` in the order of ``order``; ``before`` leaves the current row out."""
    by, order, last = list(by), list(order), -1 if before else 0
    plain = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    sums = lambda frame: {out: F.sum(c).over(frame) for out, c in cols.items()}
    light, hot = (df, None) if split == "never" else split_hot(df, by, block_rows)
    parts = [] if light is None else [light.withColumns(sums(plain))]
    if hot is not None:
        laid = lay_out(hot.df, hot.rows, by, order, block_rows)
        carry = carried(laid, by, {c: "sum" for c in cols.values()}).withColumn(_COPY, F.lit(True))
        first = F.col(_COPY).desc()
        inside = (
            Window.partitionBy(*by, BLOCK)
            .orderBy(first, *order, TIE)
            .rowsBetween(Window.unboundedPreceding, last)
        )
        parts.append(
            laid.withColumn(_COPY, F.lit(False))
            .unionByName(carry, allowMissingColumns=True)
            .withColumns(sums(inside))
            .where(~F.col(_COPY))
            .drop(_COPY, BLOCK, TIE)
        )
    return reduce(DataFrame.unionByName, parts)
