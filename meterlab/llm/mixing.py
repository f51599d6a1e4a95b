"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target of words; each of its documents is to be taken
``target / size of the source`` times on average, which leaves a fractional
probability of one more copy. Pairs of documents of one source trade: with the
right odds one gains and the other loses the same number of expected words,
until one of the two is taken or not. The words expected of the source stay the
same throughout, so its outcome differs from the target by less than one
document. Documents are dealt into groups of bounded size by a hash of their id,
so that a source with a third of all rows is many groups; the one undecided
document of each group goes up a tree in which groups of ``fan_in`` meet.

Random numbers come from hashes of ids and the seed: the same table gives the same
mix, however it is partitioned. Null texts count as empty and null sources as a
source of their own, the last one. Documents of size 0 take part with their
whole expected copies, rounded down. Rows that share a doc_id are documents of
their own. An empty table gives no rows; columns of other names are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.llm.text import pick
from meterlab.plans.blocks import running_total, settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
GROUP_ROWS = 4_096
FAN_IN = 64
SEED = 20_240_101
_LEAST = 1e-9


def word_count(text: str = "text") -> Column:
    """Number of runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in the order of code points, null last, weigh ``weights`` in turn and
    divide ``share`` of all words; none gets more than ``most`` times its size,
    and what is above is divided among the others in the same way.
    """
    totals = settle(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ordered = totals.withColumns({"last": F.col("source").isNull().cast("long"), "one": F.lit(1).cast("long")})
    ranked = running_total(ordered, [], ["last", "source"], "one", "rank")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    table = settle(
        ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("limit")),
        "source-weights",
    )
    wanted = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        # Sources whose limit is below their part at this level stay at the limit.
        stopped = F.col("limit") <= F.col("weight") * level
        sums = table.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("limit"))), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if not sums["open"]:
            break
        higher = (wanted - sums["held"]) / sums["open"]
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return table.select(
        "source", "source_size", F.least("limit", F.col("weight") * level).alias("target")
    )


def _round(size: np.ndarray, chance: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Trade in order until one document at most is undecided; its place, or -1.

    Expected words ``size * chance`` keep their sum at each trade.
    """
    chance = chance.tolist()
    size, draw = size.tolist(), draw.tolist()
    held = -1
    for i in range(len(chance)):
        if not _LEAST < chance[i] < 1 - _LEAST:
            chance[i] = float(round(chance[i]))
            continue
        if held < 0:
            held = i
            continue
        a, b, sa, sb = chance[held], chance[i], size[held], size[i]
        up = min((1 - a) * sa, b * sb)
        down = min(a * sa, (1 - b) * sb)
        words = up if draw[i] * (up + down) < down else -down
        a, b = a + words / sa, b - words / sb
        done = [not _LEAST < x < 1 - _LEAST for x in (a, b)]
        chance[held] = float(round(a)) if done[0] else a
        chance[i] = float(round(b)) if done[1] else b
        held = -1 if all(done) else (i if done[0] else held)
    return np.array(chance), held


def _draws(keys: pd.Series, salt: str) -> np.ndarray:
    return np.array([zlib.crc32(f"{salt}:{k}".encode()) / 2**32 for k in keys])


def copies(docs: DataFrame, seed: int = SEED, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies) of each document.

    ``docs`` has doc_id, source and size, and may have a number ``tag`` to tell
    rows apart that agree in these; it is returned too.
    """
    schema = "doc_id long, size long, tag long, source string, source_size long, target double, base long, chance double, key long, part long, done boolean"
    tag = F.col("tag") if "tag" in docs.columns else F.lit(0).cast("long").alias("tag")
    docs = settle(docs.select("doc_id", "source", "size", tag), "document-sizes")
    aims = targets(docs, weights, share, most)
    # Sources with more rows than a group are dealt over several groups.
    rows = docs.groupBy("source").agg(F.count("*").alias("rows"))
    spread = aims.join(rows.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    spread = settle(spread.withColumn("parts", F.floor(F.col("rows") / group_rows) + 1), "source-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(rate - F.round(rate)) < _LEAST, F.round(rate)).otherwise(rate)
    items = (
        docs.join(spread.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("key", F.xxhash64("doc_id", "size", "tag", F.lit(seed)))
        .withColumn("part", F.pmod("key", "parts"))
        .withColumn("base", F.floor(near).cast("long"))
        .withColumn("chance", F.when(F.col("size") > 0, near - F.floor(near)).otherwise(0.0))
        .withColumn("done", F.lit(False))
    )

    def trade(level: int):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["key", "doc_id", "size", "tag"], ignore_index=True)
            chance, held = _round(rows["size"].to_numpy(), rows["chance"].to_numpy(), _draws(rows["key"], f"{seed}-{level}"))
            done = np.ones(len(rows), bool)
            if held >= 0:
                done[held] = False
            return rows.assign(chance=chance, done=done)

        return run

    names = [f.split()[0] for f in schema.split(", ")]
    level = settle(
        items.select(*names).groupBy("source", "part").applyInPandas(trade(0), schema), "mixed-0"
    )
    out, left, number = level.where("done"), level.where("not done"), 0
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts, number = -(-parts // fan_in), number + 1
        up = left.withColumn("part", F.floor(F.col("part") / fan_in).cast("long"))
        level = settle(up.groupBy("source", "part").applyInPandas(trade(number), schema), f"mixed-{number}")
        out, left = out.unionByName(level.where("done")), level.where("not done")
    # One document of each source is left: it is taken with its own probability.
    lot = F.pmod(F.xxhash64("key", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    last = left.withColumn("chance", (lot < F.col("chance")).cast("double"))
    return out.unionByName(last).select(
        "doc_id", "size", "source", "tag", "source_size", "target", (F.col("base") + F.col("chance").cast("long")).alias("copies")
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each document with a text and a source."""
    sized = pick(docs, "doc_id", "source", "text").withColumn("size", word_count())
    return copies(sized, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed table: each document as often as it is taken, in its own columns.

    Texts move once, to meet the decision on them. Rows that agree in doc_id,
    source and text are told apart by a number, in any order.
    """
    names, ids = list(docs.columns), [f"_{i}" for i in range(len(docs.columns))]
    doc_id, source, text = (f"_{names.index(n)}" for n in ("doc_id", "source", "text"))
    plain = docs.toDF(*ids)
    sized = plain.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("tag"),
    )

    def keys(*columns: str) -> dict[str, Column]:
        return {f"_key{n}": F.xxhash64(*columns, F.lit(n)) for n in (1, 2)}

    taken = (
        copies(sized, seed)
        .withColumns(keys("doc_id", "source", "tag"))
        .groupBy("_key1", "_key2")
        .agg(F.sort_array(F.collect_list("copies"), asc=False).alias("_counts"))
        .where(F.get("_counts", F.lit(0)) > 0)
    )
    twins = Window.partitionBy("_key1", "_key2").orderBy("_key1")
    met = (
        plain.withColumn("_tag", F.xxhash64(text))
        .withColumns(keys(doc_id, source, "_tag"))
        .join(taken, ["_key1", "_key2"])
        .withColumn("_n", F.row_number().over(twins))
        .withColumn("_times", F.get("_counts", F.col("_n") - 1).cast("int"))
        .where("_times > 0")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
    )
    return met.select(*ids).toDF(*names)
