"""Self-join of documents by the Jaccard similarity of their word shingles, exactly.

Two sets of a similarity of ``percent`` / 100 or more differ by few tokens, say ``k``.
If all tokens are dealt to more than ``k`` parts by a hash, some parts of both sets
hold the same tokens. Only pairs with such a part in common are compared:

1. Documents with equal sets become one node; copies cost no more than one.
2. Each set is dealt to parts, ``k`` and the parts being as many as its class of sizes
   asks for, and once more as the next smaller class does. Of its parts it keeps the
   ``k + 1`` strongest: those with the most and the rarest tokens. Two linked sets have
   all parts but ``k`` in common; the strongest of these is kept in both, since
   it is dropped only where fewer than ``k`` others are weaker. Tokens of all texts are
   counted, in ``2 ** BUCKET_BITS`` buckets by hash; any order of strength is right.
3. Nodes that keep the same part form a list. The member of most lists is its pivot,
   and each member is compared in full with the pivot, which makes as many pairs as rows.
4. Links give components. A member that is not linked with its pivot may still link with
   others of the list. Two such sets have the tokens in common by which they differ
   from the pivot, more than half of the nearer one's. So these tokens are put in order, those the pivot
   lacks first, and pairs that share one early enough in both are compared. No link is
   lost, and a group of thousands of near copies is not expanded into pairs.

Words are runs of anything but ASCII white space, A-Z lower-cased. A set holds
the distinct shingles of ``size`` words; a text with fewer words has its whole
sequence as its only shingle; a null text or one without words has no shingle and
no link. Shingles are compared by 64-bit hashes. Rows that share a doc_id are
documents of their own, and a component is named after its smallest doc_id, which
ignores null ids. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterlab.llm.components import connected
from meterlab.llm.text import by_space, chunks, distinct_shingles, mix, pick, seeded
from meterlab.plans.blocks import join_on, settle, settled

SIZE = 5
PERCENT = 80
# Tokens are counted in so many bits' worth of buckets: a megabyte per task, a byte per bucket for all.
BUCKET_BITS = 18
_SLICES = 16
# Tables of one or two numbers per row are broadcast up to this many rows (some 50 MB
# in memory), larger ones are shuffled.
BROADCAST_IDS = 2_000_000


def _small(df: DataFrame) -> DataFrame:
    """Mark a stored table of ids for broadcast if a count shows that it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _fingerprint(value: np.ndarray, n: np.ndarray, salts: np.ndarray) -> list[np.ndarray]:
    """Two sums of hashes of each row's tokens, of which it has ``n``."""
    ends = np.append(0, np.cumsum(n))
    sums = []
    for salt in salts:
        total = np.append(np.uint64(0), np.cumsum(mix(value ^ salt)))
        sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return sums


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _summaries(docs: DataFrame, size: int) -> DataFrame:
    """Rows of two kinds: each document's set as (n, two sums of hashes), and a task's counts of tokens, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = by_space()
        salts = seeded(2, 41)
        times = np.zeros(1 << BUCKET_BITS, np.int64)
        names = ["slice", "doc_id", "n", "one", "two", "times"]
        for batch in batches:
            for chunk in chunks(batch[1]):
                row, value = distinct_shingles(split(chunk), chunk.rows, size)
                n = np.bincount(row, minlength=chunk.rows)
                times += np.bincount(_bucket(value), minlength=len(times))
                sums = [pa.array(x) for x in _fingerprint(value, n, salts)]
                ids = batch[0].slice(chunk.first, chunk.rows)
                none = [pa.nulls(chunk.rows, pa.int32()), pa.nulls(chunk.rows, pa.binary())]
                yield pa.RecordBatch.from_arrays([none[0], ids, pa.array(n.astype(np.int64)), *sums, none[1]], names=names)
        if times.any():
            slices = [x.astype("<i8").tobytes() for x in np.split(times, _SLICES)]
            none = [pa.nulls(_SLICES, pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SLICES, dtype=np.int32)), *none, pa.array(slices, pa.binary())], names=names)

    return docs.mapInArrow(run, "slice int, doc_id long, n long, one long, two long, times binary")


def _ranks(summaries: DataFrame) -> np.ndarray:
    """Ranks of the buckets: their counts in steps of half a power of two."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in table["times"])
        rank = np.minimum(2 * np.log2(np.maximum(total, 1)), 63).astype(np.uint8)
        return pa.table({"slice": table["slice"][:1], "ranks": pa.array([rank.tobytes()], pa.binary())})

    held = summaries.where("slice is not null").select("slice", "times")
    rows = held.groupBy("slice").applyInArrow(add, "slice int, ranks binary").collect()
    ranks = np.zeros(1 << BUCKET_BITS, np.uint8)
    for row in rows:
        np.split(ranks, _SLICES)[row["slice"]][:] = np.frombuffer(row["ranks"], np.uint8)
    return ranks


def _bounds(most: int, percent: int) -> np.ndarray:
    """The least size of each class; sets that can be linked are of the same or of neighbouring classes."""
    if percent >= 100:
        return np.arange(1, most + 2)
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(max(bounds[-1] + 1, 100 * (bounds[-1] - 1) // percent + 1))
    return np.array(bounds)


def _furthest(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """At least as many as the tokens in only one of two linked sets, the smaller of which has ``n`` or fewer."""
    return (n + 100 * n // percent) * (100 - percent) // (100 + percent)


def _parts(row: np.ndarray, value: np.ndarray, n: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the parts that sets keep, by row; equal keys mean equal parts.

    ``n`` counts the tokens (row, value) of each row, and ``rank`` says how common each is.
    """
    salts = seeded(2, 91)
    bounds = _bounds(int(n.max(initial=0)), percent)
    own = np.searchsorted(bounds, n, "right") - 1
    keep = _furthest(bounds[1:] - 1, percent) + 1
    # A quarter more, so that empty and weak parts can be dropped.
    parts = np.where(keep > 1, keep + np.maximum(2, keep // 4), 1)
    spread, hashed = mix(value ^ salts[0]) >> np.uint64(32), mix(value ^ salts[1])
    rows, keys = [], []
    for step in (0, 1):
        kind = np.maximum(own - step, 0)
        meets = n > 0
        if step:
            # Only with sets of the next smaller class that are large enough.
            meets &= (own > 0) & (100 * (bounds[np.maximum(own, 0)] - 1) >= percent * n)
        count = np.zeros(len(n), np.int64)
        count[meets] = parts[kind[meets]]
        first = np.append(0, np.cumsum(count))
        dealt = meets[row]
        of = row[dealt]
        at = first[of] + ((spread[dealt] * count[of].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(first[-1], np.uint64)
        np.add.at(sums, at, hashed[dealt])
        strength = np.bincount(at, 64.0 - rank[dealt], first[-1])
        owner = np.repeat(np.arange(len(n)), count)
        place = np.arange(first[-1]) - first[owner]
        key = mix(sums + mix(((kind[owner] << 40) + place + 1).astype(np.uint64)))
        order = np.lexsort((key, -strength, owner))
        kept = place < keep[kind[owner]]
        rows.append(owner[kept])
        keys.append(key[order][kept])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return row[order], np.concatenate(keys)[order]


def _sets(docs: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, mark, one, two, n, keys): the parts that each non-empty set keeps.

    ``mark`` is a hash of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = by_space()
        salts = seeded(2, 41)
        for batch in batches:
            for chunk in chunks(batch[1]):
                row, value = distinct_shingles(split(chunk), chunk.rows, size)
                n = np.bincount(row, minlength=chunk.rows)
                full = np.flatnonzero(n > 0)
                sums = [pa.array(x[full]) for x in _fingerprint(value, n, salts)]
                owner, key = _parts(row, value, n, common[_bucket(value)], percent)
                cuts = np.append(0, np.cumsum(np.bincount(owner, minlength=chunk.rows)[full])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch[c].slice(chunk.first, chunk.rows).take(pa.array(full)) for c in ("doc_id", "mark")],
                        *sums, pa.array(n[full].astype(np.int64)), pa.ListArray.from_arrays(cuts, pa.array(key.view(np.int64))),
                    ],
                    names=["doc_id", "mark", "one", "two", "n", "keys"],
                )

    marked = docs.withColumn("mark", F.xxhash64("text"))
    return marked.mapInArrow(run, "doc_id long, mark long, one long, two long, n long, keys array<long>")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text), one text of each node in ``wanted`` (node, doc_id, mark)."""
    found = join_on(docs.withColumn("mark", F.xxhash64("text")), _small(wanted), ["doc_id", "mark"], "inner")
    return found.groupBy("node").agg(F.first("text").alias("text"))


def _early(pivot: int, n: int, apart: int, link: bool, percent: int) -> int:
    """How many of the ``apart`` tokens in only one of a pivot and a set of ``n`` to look at.

    Sets x and y that are linked have (x apart + y apart - what x and y may differ by) / 2 of these tokens in common, so
    the first in common is no later than so many before the end, in any order. One of the two at least is not linked
    with the pivot.
    """
    common = max(1, apart - _furthest(n, percent))
    if link:
        # The other is apart by more than it and the pivot may differ by; with y it may differ by ``more``.
        change = abs(n - pivot)
        more = change - 2 * (change * percent // (100 + percent)) if n >= pivot else max(0, 2 * -(-change * percent // (100 + percent)) - change)
        common = max(common, -(-(apart + 1 - more) // 2))
    return apart - common + 1


def _compare(pairs: DataFrame, texts: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """Pairs (a, b) with what their full sets, made anew from the texts, have in common.

    ``link`` tells whether the similarity is reached, ``n`` is the size of b, ``missing`` counts tokens of
    a that b lacks, ``added`` those of b that a lacks. ``tokens`` are the first of these,
    the added ones before the missing ones. Texts travel instead of sets, as they take less room.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = by_space()

        def sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
            for chunk in chunks(column):
                row, value = distinct_shingles(split(chunk), chunk.rows, size)
                yield chunk.first, np.split(value, np.searchsorted(row, np.arange(1, chunk.rows)))

        def ordered(tokens: np.ndarray) -> np.ndarray:
            return tokens[np.lexsort((tokens, common[_bucket(tokens)]))]

        for batch in batches:
            a = batch["a"].to_numpy()
            link, size_b, missing, added, tokens = [], [], [], [], []
            for first, theirs in sets(batch["tb"]):
                # Rows come by a, so few sets are made for a run of them.
                _, where, which = np.unique(a[first : first + len(theirs)], return_index=True, return_inverse=True)
                ours = [x for _, part in sets(batch["ta"].take(pa.array(first + where))) for x in part]
                for i, other in enumerate(theirs, first):
                    mine = ours[which[i - first]]
                    at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                    both = mine[at] == other
                    shared = int(both.sum())
                    lacks = np.ones(len(mine), bool)
                    lacks[at[both]] = False
                    link.append(100 * shared >= percent * (len(mine) + len(other) - shared))
                    size_b.append(len(other))
                    missing.append(len(mine) - shared)
                    added.append(len(other) - shared)
                    early = _early(len(mine), len(other), missing[-1] + added[-1], link[-1], percent)
                    tokens.append(np.append(ordered(other[~both]), ordered(mine[lacks]))[:early].view(np.int64))
            cuts = np.append(0, np.cumsum([len(x) for x in tokens])).astype(np.int32)
            lists = pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.zeros(0, np.int64), *tokens])))
            numbers = [pa.array(x, pa.int64()) for x in (size_b, missing, added)]
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(link, pa.bool_()), *numbers, lists],
                names=["a", "b", "link", "n", "missing", "added", "tokens"],
            )

    met = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return met.mapInArrow(run, "a long, b long, link boolean, n long, missing long, added long, tokens array<long>")


def _most_different(na: Column, nb: Column, percent: int) -> Column:
    """How many tokens may be in only one of two linked sets of these sizes."""
    least_shared = F.ceil((na + nb) * percent / F.lit(100 + percent))
    return na + nb - 2 * least_shared


def classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, one, two) of every row; rows with equal (one, two, n) are copies.

    The result is stored, and the tables that led to it are deleted.
    """
    return settled(lambda: _classes(docs, size, percent), "classes")


def _classes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    docs = pick(docs, "doc_id", "text")
    summaries = settle(_summaries(docs, size), "shingle-sums")
    common = _ranks(summaries)
    each = summaries.where("slice is null").drop("slice", "times")

    # 1, 2: nodes, with a number that stays because the table is stored.
    nodes = settle(
        # One document's text stands for all; the smallest id, nulls left out, names them.
        _sets(docs, size, percent, common).groupBy("one", "two", "n")
        .agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "mark")).alias("text_of"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )

    # 3: lists of nodes that keep the same part, their pivots, and pairs with these.
    rows = nodes.select("node", F.explode("keys").alias("key"))
    shared = _small(settle(rows.groupBy("key").count().where("count > 1").select("key"), "shared-parts"))
    members = settle(rows.join(shared, "key"), "members")
    ranked = members.join(members.groupBy("node").agg(F.count("*").alias("lists")), "node")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("lists", "node"))["node"].alias("a"))
    stars = settle(
        members.join(pivots, "key").where("a <> node")
        .select("a", F.col("node").alias("b")).distinct(),
        "star-pairs",
    )

    def compare(pairs: DataFrame) -> DataFrame:
        """Sets are computed anew, for the nodes of these pairs only."""
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = settle(nodes.join(_small(settle(ends, "ends")), "node").select("node", "text_of.doc_id", "text_of.mark"), "wanted")
        return settle(_compare(pairs, _texts(docs, wanted), size, percent, common), "compared")

    compared = compare(stars)
    links = compared.where("link").select("a", "b")
    roots = connected(links)

    # 4: members of a list outside the component of its pivot, and what differs from the pivot.
    def with_root(df: DataFrame, node: str, name: str) -> DataFrame:
        named = roots.select(F.col("node").alias(node), F.col("root").alias(name))
        return df.join(named, node, "left").withColumn(name, F.coalesce(name, node))

    group = settle(with_root(with_root(compared.drop("link"), "a", "ra"), "b", "rb"), "groups")
    unsettled = group.where("ra <> rb").select("a").distinct()
    marks = (
        group.join(_small(settle(unsettled, "unsettled")), "a")
        .withColumn("alone", F.col("ra") != F.col("rb"))
        .select("a", "b", "rb", "n", "missing", "added", "alone", F.posexplode("tokens").alias("place", "token"))
    )
    x = marks.where("alone").drop("alone").alias("x")
    y = marks.drop("alone").alias("y")
    differ = _most_different(F.col("x.n"), F.col("y.n"), percent)
    # How many of the tokens they share if they are linked; the first of them has the others behind it.
    twice = F.col("x.missing") + F.col("x.added") + F.col("y.missing") + F.col("y.added") - differ
    early = [2 * (F.col(f"{s}.missing") + F.col(f"{s}.added") - F.col(f"{s}.place")) >= twice for s in "xy"]
    met = x.join(y, (F.col("x.a") == F.col("y.a")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.rb") != F.col("y.rb"))
        & (F.abs(F.col("x.missing") - F.col("y.missing")) + F.abs(F.col("x.added") - F.col("y.added")) <= differ)
        & early[0] & early[1])
    left = met.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = settle(left.join(tried, ["a", "b"], "left_anti"), "pairs-left")
    if not rest.isEmpty():
        found = compare(rest).where("link").select("a", "b")
        if not found.isEmpty():
            roots = connected(links.unionByName(found))

    # Names: the smallest doc_id of all copies of all nodes of a component.
    named = nodes.select("one", "two", "n", "node", "doc_id")
    rooted = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = settle(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    table = rooted.join(names, "root").select("one", "two", "n", "component_id")
    return each.join(table, ["one", "two", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "one", "two"
    )


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One document of each group: the one with the smallest doc_id; rows without words all stay.

    Of several rows with that doc_id all stay, so ids should be unique.
    """
    found = classes(docs, size, percent)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("_gone"))
    kept = found.where("component_id = doc_id or n_shingles = 0").select(F.col("doc_id").alias("_gone"))
    gone = gone.join(kept.distinct(), "_gone", "left_anti").distinct()
    names = list(docs.columns)
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.join(gone, F.col(f"_{names.index('doc_id')}") == F.col("_gone"), "left_anti").toDF(*names)
