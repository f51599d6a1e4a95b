"""Hard negatives of anchors: near rows of another label, by exact integer inner products.

Components become integers, ``floor(256 * x)``. Scores are computed in the manner of the
Four Russians: the components of a candidate are packed into bit planes, one byte for
eight dimensions, and each anchor has a table of the 256 subset sums of each group of
eight of its components. A byte of a plane is an index into its group's table; what the
tables give is added up by plane, shifted by the plane's place, and the plane of the sign
is taken off. That is the whole inner product, in 64 bits, exactly.

Anchors are a stated set, and every anchor meets every candidate: both are dealt into
tiles of at most about ``TILE_ANCHORS`` by ``TILE_ROWS``, by a hash of their row, so that
no label makes a tile large. A tile gives the best few of each of its anchors, and a
window takes the best of all tiles. The first pass scores rows of the anchor's label and
finds its positives; the second one those of other labels, and looks up those in the band
that each positive's score allows.

A row takes part if it has an id, a label and a vector without nulls and non-finite numbers.
Shorter vectors count as if zeros followed, an empty one as zeros only. Rows that share an
id are rows of their own, but an anchor is compared with no row of its own id. Vectors whose
scores could leave 64 bits raise an error. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.llm.text import pick
from meterlab.plans.blocks import settle

SCALE = 256
GROUP = 8
TILE_ROWS = 4096
TILE_ANCHORS = 4096
# Rows and anchors that are scored at a time, so that sums stay in the processor's cache.
_ROWS, _ANCHORS = 1024, 128
LARGEST = 2**63 - 1


def usable(table: DataFrame, id_column: str, column: str, label: Column) -> DataFrame:
    """(row, id, label, vector) of the rows that take part, with scaled components."""
    names = list(dict.fromkeys([id_column, column, "label"]))
    rows = pick(table, *names).withColumn("_label", label)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col("_label").cast("long").alias("label"),
        F.col(f"`{column}`").cast("array<double>").alias("vector"),
    )
    rows = rows.where("id is not null and label is not null and vector is not null").where(F.forall("vector", finite))
    # Scaled values stay doubles until their size is known.
    scaled = rows.select("id", "label", F.transform("vector", lambda x: x * SCALE).alias("vector"))
    return settle(scaled.withColumn("row", F.monotonically_increasing_id()), "usable-vectors")


class Shape:
    """How vectors are packed: ``groups`` of eight dimensions in ``planes`` of bits."""

    def __init__(self, dimensions: int, largest: int):
        if largest * largest * max(dimensions, 1) * 100 > LARGEST:
            raise ValueError(f"scores of components up to {largest} may leave 64 bits")
        self.groups = max(1, -(-dimensions // GROUP))
        self.planes = largest.bit_length() + 1
        # Sums inside a tile fit 32 bits where the largest possible score does.
        small = largest * (1 << self.planes) * self.groups * GROUP < 2**31
        self.kind = np.int32 if small else np.int64

    def pack(self, values: np.ndarray) -> np.ndarray:
        """Bytes (rows, planes, groups): bit ``j`` of a byte is that plane's bit of the group's dimension ``j``."""
        bits = (values[:, None, :] >> np.arange(self.planes)[None, :, None]) & 1
        return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")

    def tables(self, anchors: np.ndarray) -> np.ndarray:
        """Subset sums (groups, 256, anchors): entry ``s`` adds up the components whose bits ``s`` has."""
        parts = anchors.reshape(len(anchors), self.groups, GROUP).transpose(1, 2, 0).astype(self.kind)
        sums = np.zeros((self.groups, 1, len(anchors)), self.kind)
        for j in range(GROUP):
            sums = np.concatenate([sums, sums + parts[:, j : j + 1]], axis=1)
        return sums

    def scores(self, packed: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Inner products (rows, anchors), by looking up bytes, adding and shifting."""
        total = np.zeros((len(packed), tables.shape[2]), self.kind)
        for plane in range(self.planes - 1, -1, -1):
            found = tables[0][packed[:, plane, 0]]
            for g in range(1, self.groups):
                found += tables[g][packed[:, plane, g]]
            # Horner's rule from the plane of the sign, which counts negatively.
            total = -found if plane == self.planes - 1 else (total << 1) + found
        return total


def _shape(rows: DataFrame) -> Shape:
    size = F.greatest(-F.array_min("vector"), F.array_max("vector"))
    most = rows.agg(F.max(F.size("vector")).alias("n"), F.max(size).alias("m")).first()
    return Shape(most["n"] or 0, math.ceil(most["m"] or 0) or 1)


def _packed(rows: DataFrame, shape: Shape) -> DataFrame:
    """(row, id, label, ints, planes): components as 64-bit integers, and as bit planes."""
    width = shape.groups * GROUP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch["vector"]
            length = np.asarray(vector.value_lengths())
            values = np.zeros((len(vector), width), np.int64)
            row = np.repeat(np.arange(len(vector)), length)
            place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            values[row, place] = np.floor(vector.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
            planes = shape.pack(values)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in ("row", "id", "label")],
                    pa.array([v.tobytes() for v in values.astype("<i8")], pa.binary()),
                    pa.array([v.tobytes() for v in planes], pa.binary()),
                ],
                names=["row", "id", "label", "ints", "planes"],
            )

    kinds = "row long, id long, label long, ints binary, planes binary"
    return settle(rows.select("row", "id", "label", "vector").mapInArrow(run, kinds), "bit-planes")


def _raw(column: pa.ChunkedArray) -> bytes:
    return b"".join(v.as_buffer().to_pybytes() for v in column)


def _tiles(anchors: DataFrame, packed: DataFrame) -> tuple:
    """Anchors and candidates, copied to each tile (up, across) that they belong to, and grouped."""
    up = -(-anchors.count() // TILE_ANCHORS) or 1
    across = -(-packed.count() // TILE_ROWS) or 1
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    a = anchors.select("*", deal(up).alias("up"), spread(across).alias("across"))
    c = packed.drop("ints").select("*", deal(across).alias("across"), spread(up).alias("up"))
    return a.groupBy("up", "across"), c.groupBy("up", "across")


def _each(shape: Shape, anchors: pa.Table, rows: pa.Table, same: bool) -> Iterator[tuple]:
    """(places of anchors, ids of candidates, scores, whether the ids differ) of a tile, by anchors of one label.

    Candidates are those of the same label, or those of others, ascending by id.
    """
    order = np.lexsort((rows["row"].to_numpy(), rows["id"].to_numpy()))
    ids, labels = rows["id"].to_numpy()[order], rows["label"].to_numpy()[order]
    planes = np.frombuffer(_raw(rows["planes"]), np.uint8).reshape(len(rows), shape.planes, shape.groups)[order]
    ints = np.frombuffer(_raw(anchors["ints"]), "<i8").reshape(len(anchors), -1)
    a_ids, a_labels = anchors["id"].to_numpy(), anchors["label"].to_numpy()
    for label in np.unique(a_labels):
        chosen = np.flatnonzero((labels == label) == same)
        mine = np.flatnonzero(a_labels == label)
        if not len(chosen):
            continue
        for i in range(0, len(mine), _ANCHORS):
            part = mine[i : i + _ANCHORS]
            tables = shape.tables(ints[part])
            score = np.concatenate([shape.scores(planes[chosen[r : r + _ROWS]], tables) for r in range(0, len(chosen), _ROWS)])
            yield part, ids[chosen], score.T.astype(np.int64), ids[chosen][None, :] != a_ids[part][:, None]


def _top(score: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, ties by place, in that order."""
    if len(score) > most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        higher, equal = np.flatnonzero(score > least), np.flatnonzero(score == least)
        places = np.concatenate([higher, equal[: most - len(higher)]])
    else:
        places = np.arange(len(score))
    return places[np.lexsort((places, -score[places]))]


def _table(columns: dict, kinds: dict) -> pa.Table:
    arrays = [pa.array(np.concatenate(columns[c]) if columns[c] else [], t) for c, t in kinds.items()]
    return pa.Table.from_arrays(arrays, names=list(kinds))


def positives(anchors: DataFrame, packed: DataFrame, shape: Shape, most: int) -> DataFrame:
    """(row, positive_id, positive_score, place): the nearest rows of the anchor's label."""
    kinds = {"row": pa.int64(), "positive_id": pa.int64(), "positive_score": pa.int64()}

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        out = {k: [] for k in kinds}
        if len(a) and len(c):
            own = a["row"].to_numpy()
            for part, ids, score, other in _each(shape, a, c, same=True):
                for k, s, o in zip(part, score, other, strict=True):
                    found = np.flatnonzero(o)
                    found = found[_top(s[found], most)]
                    out["row"].append(np.full(len(found), own[k]))
                    out["positive_id"].append(ids[found])
                    out["positive_score"].append(s[found])
        return _table(out, kinds)

    a, c = _tiles(anchors, packed)
    found = a.cogroup(c).applyInArrow(run, "row long, positive_id long, positive_score long")
    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)


def negatives(anchors: DataFrame, packed: DataFrame, shape: Shape, most: int, low: int, high: int) -> DataFrame:
    """(row, place, negative_id, negative_score, rank) per positive, from the band that its score allows.

    ``anchors`` has the lists places and scores of its positives.
    """
    kinds = {"row": pa.int64(), "place": pa.int32(), "negative_id": pa.int64(), "negative_score": pa.int64()}

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        out = {k: [] for k in kinds}
        if len(a) and len(c):
            own, places, scores = a["row"].to_numpy(), a["places"].to_pylist(), a["scores"].to_pylist()
            for part, ids, score, other in _each(shape, a, c, same=False):
                for k, s, o in zip(part, score, other, strict=True):
                    for place, positive in zip(places[k], scores[k], strict=True):
                        hundred = 100 * s
                        found = np.flatnonzero(o & (hundred >= low * positive) & (hundred <= high * positive))
                        found = found[_top(s[found], most)]
                        out["row"].append(np.full(len(found), own[k]))
                        out["place"].append(np.full(len(found), place, np.int32))
                        out["negative_id"].append(ids[found])
                        out["negative_score"].append(s[found])
        return _table(out, kinds)

    a, c = _tiles(anchors, packed)
    found = a.cogroup(c).applyInArrow(run, "row long, place int, negative_id long, negative_score long")
    best = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def mine(
    table: DataFrame,
    wanted: Column,
    label: Column,
    positives_each: int = 5,
    negatives_each: int = 10,
    low: int = 30,
    high: int = 90,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that fulfil ``wanted`` (of ``id``). ``label`` is computed from the
    table's columns ``id_column`` and ``label``. A negative's score lies between ``low`` and ``high`` per cent
    of the positive's. Higher scores come first, ties by smaller id.
    """
    rows = usable(table, id_column, column, label)
    shape = _shape(rows)
    packed = _packed(rows, shape)
    anchors = settle(packed.where(wanted).select("row", "id", "label", "ints"), "anchors")
    near = settle(positives(anchors, packed, shape, positives_each), "positives")
    lists = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    lists = lists.select("row", F.col("p.place").alias("places"), F.col("p.positive_score").alias("scores"))
    far = negatives(anchors.join(lists, "row"), packed, shape, negatives_each, low, high)
    named = near.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return far.join(named, ["row", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
