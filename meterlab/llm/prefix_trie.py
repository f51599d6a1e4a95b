"""The trie of all prefixes of conversations, from sorted order and shared prefix lengths.

Turns become digests of role and text, and a conversation the string of its digests, so
texts are read once and never shuffled. Conversations are sorted, over the cluster, by
these strings. Those that begin with a prefix are then neighbours, and it is enough to
know how many turns each row shares with the row before it (LCP):

* A block of sorted rows builds a sparse table of range minima over its LCPs. Every
  prefix of every row is a candidate; by binary search in that table it finds how far
  rows with that prefix reach to the left, and those that reach none further, once per
  prefix and block, to the right. No candidate waits for another, and there is no stack.
* Prefix sums over the rows turn such an interval into the number of leaves below a
  node and the words that its subtree shares; a second sparse table gives the smallest member.
* An interval that goes on in the next block, which LCPs across the border tell, is one row
  per block, and these are added up by the prefix's digest. There are at most as
  many as the border rows are long.

Long conversations are cut into segments of ``SEGMENT`` turns. A segment sorts below a
fingerprint of all turns before it, so a node stays an interval of rows of one segment
number, and no row grows with a conversation. What later segments add to the leaves and shared
words of earlier ones is summed up per conversation beforehand.

Turns are numbered by ``turn``, null first, and turns of equal number by the digests of
role and text; repeated rows are turns of their own. A null role or text is empty. Rows
without a conv_id take no part. An empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlab.llm.text import pick
from meterlab.plans.blocks import BROADCAST_ROWS, running_total, settle

SEGMENT = 256
BLOCK_TURNS = 1 << 18
WORDS = r"[^\x20\x09-\x0D]+"
_DIGEST = 16

_NODE = (
    "key binary, block int, parent_key binary, ends string, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def turns_of(table: DataFrame) -> DataFrame:
    """(conv_id, place, digest, words): turns in order, places from 1, words of the text counted."""
    rows = pick(table, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.sha2(told, 256), 1, 2 * _DIGEST).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).alias("words"),
        F.lit(1).cast("long").alias("one"),
    )
    numbered = running_total(turns, ["conv_id"], ["turn", "digest"], "one", "place")
    return settle(numbered.select("conv_id", "place", "digest", "words"), "turns")


def with_heads(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``head`` turns of the conversation ``base``, then go on
    with their own after as many; both are expressions of conv_id, and ``head`` is at most ``most``.

    Gives the turns, and (conv_id, n) of all conversations, also of those without a turn.
    """
    turn = F.struct("place", "digest", "words")
    heads = turns.where(F.col("place") <= most).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(turn)).alias("first")
    )
    own = turns.groupBy("conv_id").agg(F.max("place").alias("n")).withColumn("base", base).withColumn("head", head)
    taken = F.filter(F.coalesce("first", F.array()), lambda t: t["place"] <= F.col("head"))
    each = settle(own.join(heads, "base", "left").select("conv_id", "n", "head", taken.alias("taken")), "heads")
    size = F.size("taken").cast("long")
    tails = turns.join(each.select("conv_id", "head", size.alias("taken")), "conv_id").where("place > head").select(
        "conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "digest", "words"
    )
    fronts = each.select("conv_id", F.explode("taken").alias("t")).select("conv_id", "t.place", "t.digest", "t.words")
    return fronts.unionByName(tails), each.select("conv_id", (size + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("n"))


def _segments(turns: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """(conv_id, seg, path, words, under, after): segments, the last of each conversation not full and possibly empty.

    ``under`` is a fingerprint of all turns before a segment, empty for the first, ``after`` one of all
    up to its end where it is full.
    """
    ends = lengths.select("conv_id", (F.col("n") + 1).alias("place"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("int").alias("words"))
    rows = turns.unionByName(ends).withColumn("seg", F.expr(f"(place - 1) div {segment}"))
    grouped = rows.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("t"))
    stored = settle(
        grouped.select(
            "conv_id", "seg", F.unhex(F.array_join("t.digest", "")).alias("path"),
            F.filter("t.words", lambda w: w.isNotNull()).alias("words"),
        ),
        "segments",
    )
    # Only what belongs to conversations of several segments needs sums over these.
    several = (F.col("seg") > 0) | (F.size("words") == segment)
    seal = F.sha2(F.concat(F.hex("seg"), F.lit("/"), F.hex("path")), 256)
    parts = [F.conv(F.substring(seal, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(2)]
    series = Window.partitionBy("conv_id").orderBy("seg")
    frame = {"under": series.rowsBetween(Window.unboundedPreceding, -1), "after": series.rowsBetween(Window.unboundedPreceding, 0)}
    number = {"under": F.col("seg"), "after": F.col("seg") + 1}

    def mark(name: str) -> Column:
        sums = [F.sum(p).over(frame[name]).cast("string") for p in parts]
        return F.concat_ws("/", F.lpad(number[name].cast("string"), 12, "0"), *sums).cast("binary")

    none = F.lit(b"")
    long = stored.where(several).select(
        "*", F.when(F.col("seg") == 0, none).otherwise(mark("under")).alias("under"),
        F.when(F.size("words") == segment, mark("after")).alias("after"),
    )
    short = stored.where(~several).select("*", none.alias("under"), F.lit(None).cast("binary").alias("after"))
    return long.unionByName(short)


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Minima of the runs of 1, 2, 4, ... values from each place on."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def _reach(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray, ahead: bool) -> np.ndarray:
    """The last row, ahead or back, up to which all LCPs after row ``at`` (or before) are ``depth`` or more."""
    last, found = len(levels[0]) - 1, at.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        if ahead:
            within, first = found + step <= last, found + 1
        else:
            within, first = found - step >= 0, found - step + 1
        first = np.clip(first, 0, len(levels[k]) - 1)
        far = within & (levels[k][first] >= depth)
        found = np.where(far, found + step if ahead else found - step, found)
    return found


def _least(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of the rows ``first`` to ``last``."""
    k = np.frexp((last - first + 1).astype(float))[1] - 1
    out = np.empty(len(first), levels[0].dtype)
    for level in np.unique(k):
        of = k == level
        out[of] = np.minimum(levels[level][first[of]], levels[level][last[of] - (1 << level) + 1])
    return out


class _Block:
    """Sorted rows of segments with LCPs; ``shared[i]`` belongs to rows i - 1 and i, the last one to the row after the block."""

    def __init__(self, rows: pa.Table, border: pa.Table, segment: int):
        columns = {c: rows[c].to_pylist() for c in ("conv_id", "seg", "path", "under", "after")}
        order = sorted(range(len(rows)), key=lambda i: (columns["under"][i], columns["path"][i], columns["conv_id"][i]))
        self.order = np.array(order, np.int64)
        self.path, self.under, self.after = ([columns[c][i] for i in order] for c in ("path", "under", "after"))
        self.conv, self.seg = (np.array(columns[c], np.int64)[self.order] for c in ("conv_id", "seg"))
        self.segment, self.count = segment, len(order)
        self.size = np.array([len(p) for p in self.path], np.int64) // _DIGEST
        before, next_ = border["before"][0].as_py(), border["next"][0].as_py()
        under = [before["under"] if before else None, *self.under, next_["under"] if next_ else None]
        path = [before["path"] if before else b"", *self.path, next_["path"] if next_ else b""]
        digests = np.frombuffer(b"".join(path), "<u8").reshape(-1, 2)
        size = np.array([len(p) for p in path], np.int64) // _DIGEST
        first = np.cumsum(size) - size
        least = np.minimum(size[:-1], size[1:])
        row = np.repeat(np.arange(len(least)), least)
        place = np.arange(len(row)) - np.repeat(np.cumsum(least) - least, least)
        differs = (digests[first[row] + place] != digests[first[row + 1] + place]).any(axis=1)
        shared = least.copy()
        np.minimum.at(shared, row[differs], place[differs])
        shared[[a != b for a, b in zip(under[:-1], under[1:], strict=True)]] = -1
        self.shared = shared
        # Words up to each turn: those of row i begin at sums_at[i], with 0 for none.
        words = rows["words"].combine_chunks().take(pa.array(self.order))
        flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.append(0, np.cumsum(flat))
        self.word_total, self.word_at = total, np.cumsum(self.size) - self.size
        #: Words of the turns that a row shares with the row before it.
        self.common = self.words_before(np.arange(self.count), np.maximum(shared[:-1], 0))
        # The last of equal rows is a leaf if no row goes on from it.
        self.leaf = (self.size < segment) & (shared[1:] < self.size)

    def words_before(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.word_total[self.word_at[row] + depth] - self.word_total[self.word_at[row]]

    def key(self, row: int, depth: int) -> bytes:
        """A name of the node that begins at ``row``, the same in all blocks and segments."""
        if depth == self.segment:
            return self.after[row]
        if depth == 0 and self.under[row]:
            return self.under[row]
        return hashlib.blake2b(self.under[row] + b"|" + self.path[row][: depth * _DIGEST], digest_size=16).digest()


def _shares(segment: int):
    """For later segments: whether a row is a leaf, and the words it shares."""

    def run(rows: pa.Table, border: pa.Table) -> pa.Table:
        names = ["conv_id", "seg", "leaves", "saved"]
        if not len(rows):
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 4, names=names)
        block = _Block(rows, border, segment)
        of = block.seg > 0
        return pa.Table.from_arrays([pa.array(x[of].astype(np.int64)) for x in (block.conv, block.seg, block.leaf, block.common)], names=names)

    return run


def _nodes(segment: int):
    def run(rows: pa.Table, border: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("key", pa.binary()), ("block", pa.int32()), ("parent_key", pa.binary()), ("ends", pa.string())]
            + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
            + [("ends_sha256", pa.string())]
        )
        if not len(rows):
            return schema.empty_table()
        b = _Block(rows, border, segment)
        n, shared = b.count, b.shared
        inside = shared[:-1].copy()
        inside[0] = -2
        levels = _sparse(inside)

        # Candidates: all prefixes of all rows, of depth 0 too.
        row = np.repeat(np.arange(n), b.size + 1)
        first_of = np.cumsum(b.size + 1) - (b.size + 1)
        depth = np.arange(len(row)) - first_of[row]
        left = _reach(levels, row, depth, ahead=False)
        mine = np.flatnonzero(left == row)
        node_of = np.full(len(row), -1)
        node_of[mine] = np.arange(len(mine))
        lo, d = row[mine], depth[mine]
        hi = _reach(levels, lo, d, ahead=True)

        goes_back = (lo == 0) & (shared[0] >= d)
        goes_on = (hi == n - 1) & (shared[n] >= d)
        upper = (d == 0) & (b.seg[lo] > 0)  # the end of an earlier segment, seen from the later one
        opened = goes_back | goes_on | upper | (d == segment)
        least = _least(_sparse(b.conv), lo, hi)

        # Children: nodes one deeper that begin in the interval.
        begins = np.sort((d * n + lo)[~goes_back & (d > 0)])
        children = np.searchsorted(begins, (d + 1) * n + hi, "right") - np.searchsorted(begins, (d + 1) * n + lo, "left")

        order = pa.array(b.order)
        later_leaves, later_saved = (rows[c].combine_chunks().take(order).to_numpy(zero_copy_only=False) for c in ("later_leaves", "later_saved"))
        sums = lambda x: np.append(0, np.cumsum(x.astype(np.int64)))
        leaves, later, common = sums(b.leaf + later_leaves), sums(later_saved), sums(b.common)
        above = b.words_before(lo, np.maximum(d - 1, 0))
        saved = later[hi + 1] - later[lo] + common[hi + 1] - common[lo + 1] - (hi - lo) * above
        saved += np.where(goes_back, b.common[lo] - above, 0)

        # Conversations that end here are the first rows of the interval, ascending by id.
        same = np.append(False, (b.size[1:] == b.size[:-1]) & (shared[1:n] == b.size[1:]))
        starts = np.append(np.flatnonzero(~same), n)
        past = starts[np.searchsorted(starts, lo, "right")]
        ending = (b.size[lo] == d) & (d < segment)

        # A node's parent is the candidate one turn shorter of the same row, found at its own left end.
        up = np.maximum(first_of[lo] + d - 1, 0)
        parent = node_of[first_of[left[up]] + np.maximum(d - 1, 0)]
        has = d > 0
        out = {f.name: [None] * len(mine) for f in schema}
        numbers = dict(
            conv_id=least, depth=b.seg[lo] * segment + d, n_convs=hi - lo + 1, n_children=children,
            n_leaves=leaves[hi + 1] - leaves[lo], saved_tokens=saved,
        )
        numbers = {c: v.tolist() for c, v in numbers.items()}
        number = rows["block"][0].as_py()
        empty = hashlib.sha256().hexdigest()
        for i in range(len(mine)):
            text = ",".join(map(str, b.conv[lo[i] : past[i]].tolist())) if ending[i] else None
            if opened[i]:
                out["key"][i], out["ends"][i], out["block"][i] = b.key(lo[i], d[i]), text, number
            else:
                out["ends_sha256"][i] = hashlib.sha256(text.encode()).hexdigest() if text else empty
            if has[i]:
                p = parent[i]
                if opened[p]:
                    out["parent_key"][i] = b.key(lo[p], d[p])
                else:
                    out["parent_conv_id"][i] = numbers["conv_id"][p]
            for c, v in numbers.items():
                out[c][i] = v[i]
            if upper[i]:
                # Members, leaves and words are told by the earlier segment.
                out["conv_id"][i], out["n_convs"][i], out["n_leaves"][i], out["saved_tokens"][i] = None, 0, 0, 0
        return pa.Table.from_pydict(out, schema=schema)

    return run


def _digests(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) of texts that come in pieces, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hasher = None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for k, text in zip(batch["key"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done[0].append(key)
                        done[1].append(hasher.hexdigest())
                    key, hasher = k, hashlib.sha256()
                else:
                    hasher.update(b",")
                hasher.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hasher.hexdigest()])], names=["key", "ends_sha256"])

    dealt = pieces.repartition("key").sortWithinPartitions("key", "block").select("key", "ends")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    ``turns`` has conv_id, place (from 1), digest (hexadecimal) and words, ``lengths`` conv_id and n, the number of turns.
    """
    spark = turns.sparkSession
    segments = settle(_segments(turns, lengths, segment), "segments-with-marks")
    total = segments.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    blocks = max(total // block_turns + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = settle(
        segments.repartitionByRange(blocks, "under", "path", "conv_id").withColumn("block", F.spark_partition_id()), "sorted-blocks"
    )
    ends = F.struct("under", "path")
    by_block = Window.orderBy("block")
    edges = sorted_.groupBy("block").agg(F.min(ends).alias("least"), F.max(ends).alias("most"))
    borders = settle(
        edges.select("block", F.lag("most").over(by_block).alias("before"), F.lead("least").over(by_block).alias("next")), "borders"
    )

    several = (F.col("seg") > 0) | F.col("after").isNotNull()
    long = sorted_.where(several)
    nothing = F.lit(0).cast("long")
    whole = sorted_.where(~several).select("*", nothing.alias("later_leaves"), nothing.alias("later_saved"))
    if not long.isEmpty():
        shares = sorted_.groupBy("block").cogroup(borders.groupBy("block")).applyInArrow(
            _shares(segment), "conv_id long, seg long, leaves long, saved long"
        )
        after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
        later = long.select("conv_id", "seg").join(settle(shares, "shares"), ["conv_id", "seg"], "left").select(
            "conv_id", "seg",
            *[F.coalesce(F.sum(c).over(after), nothing).alias(f"later_{c}") for c in ("leaves", "saved")],
        )
        whole = whole.unionByName(long.join(settle(later, "later"), ["conv_id", "seg"]), allowMissingColumns=True)
    found = settle(whole.groupBy("block").cogroup(borders.groupBy("block")).applyInArrow(_nodes(segment), _NODE), "nodes")

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    opened = found.where("key is not null")
    sums = opened.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        F.max("parent_conv_id").alias("inner_parent"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    told = _digests(opened.where("ends is not null").select("key", "block", "ends"))
    nobody = F.sha2(F.lit(""), 256)
    merged = settle(sums.join(told, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nobody)), "merged-nodes")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("outer_parent"))
    if merged.count() <= BROADCAST_ROWS:
        parents = F.broadcast(parents)
    # Nodes whose parents are known in their block need no join.
    rest = found.where("key is null and parent_key is not null").drop("parent_conv_id").unionByName(
        merged.where("parent_key is not null").drop("inner_parent"), allowMissingColumns=True
    )
    return (
        found.where("key is null and parent_key is null").select(*names)
        .unionByName(merged.where("parent_key is null").withColumnRenamed("inner_parent", "parent_conv_id").select(*names))
        .unionByName(rest.join(parents, "parent_key").withColumnRenamed("outer_parent", "parent_conv_id").select(*names))
    )
