"""Approximate nearest neighbours by largest inner product: NN-descent and graph search.

Equal vectors are one node of the graph, with a number of its own. Nodes are dealt ``DEALS``
times into parts of about ``DEAL_NODES``: each time they are sorted, over the cluster, by the
signs of random projections and cut into even ranges, so that a part holds near ones. A node's
list starts with its nearest ones of its parts, which for small tables are all.

NN-descent then improves the lists. In each round a node draws up to ``SAMPLE`` new and as many
old entries of its list, and of the nodes that drew it, and introduces them to one another
if at least one of the two is new; who is nearer than the last of a list enters it. What has been
drawn is old from then on. Neighbours of neighbours meet by joins: nodes lie in parts of about ``PART_NODES``
by hash, a part asks once for each vector that its nodes drew, so what moves grows with the
number of nodes, and what it finds is sent to the parts of the nodes concerned. It ends
when fewer than ``LEAST_CHANGE`` of the entries are new.

Queries walk the graph greedily, all at once: each keeps its ``BEAM`` nearest so far (twice as many as
are asked for, at least) and in every round looks at the lists of the nearest ``STEP`` of them whose lists it has
not seen, until it has seen those of all; what it has met it does not fetch again. Should either not end within ``MOST_ROUNDS``,
an error says so. Queries begin at the ``STARTS`` longest nodes, and those that are nodes also at
themselves. The measure of what is found is computed anew, in double precision, on the original vectors.

Vectors of different lengths are reduced to one more component, ``sqrt(1 - n * n)`` for
the length ``n``, which makes all equally long, so that near in angle means large in
inner product; it is 0 for queries. Length 1 is that of the longest node after the
``STARTS`` longest. These stand in the graph as if they had length 1, and every query
gets them as candidates. Vectors travel as components of 16 bits relative to their own
largest, with a scale of 32 bits, and of the additional component what it lacks
to 1 is kept, in 32 bits: so the rounding of a vector that is much shorter than others is as much smaller.

Vectors that are null, zero, of another dimension than most, or that hold a null or a
non-finite number take no part; nor do rows with a null id. Each row that is asked about is a
query of its own, also where rows share an id, and every other row a candidate. Fewer candidates than
asked for are all returned. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterlab.llm.text import pick
from meterlab.plans.blocks import settle

NEIGHBOURS = 48
SAMPLE = 12
MOST_ROUNDS = 200
LEAST_CHANGE = 0.05
DEALS = 12
DEAL_NODES = 4096
PART_NODES = 512
BEAM = 96
STEP = 24
STARTS = 16
QUERIES_PER_PART = 16
# Signs that order a deal; ranges of DEAL_NODES need more than so many bits only beyond 10^9 nodes.
_SIGNS = 20

_GRAPH = "part int, node long, nbr array<long>, score array<float>, fresh array<boolean>"


def _part(column: str, parts: int):
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def _pack(rows: np.ndarray, lack: np.ndarray) -> list[bytes]:
    """Vectors as a scale and what the additional component lacks to 1, in 32 bits, and components in 16 bits."""
    scale = np.abs(rows).max(axis=1, initial=1e-300)
    heads = np.column_stack([scale, lack]).astype("<f4")
    small = (rows / scale[:, None]).astype("<f2")
    return [h.tobytes() + x.tobytes() for h, x in zip(heads, small, strict=True)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of packed vectors as one matrix, what is lacking last."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(values):
        return np.zeros((0, 1), np.float32)
    raw = np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in values), np.uint8).reshape(len(values), -1)
    heads = raw[:, :8].copy().view("<f4")
    return np.column_stack([raw[:, 8:].copy().view("<f2").astype(np.float32) * heads[:, :1], heads[:, 1]])


def _near(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Inner products, less 1, of packed vectors, whose last components are what they lack to 1."""
    return some @ others.T - some[:, -1:] - others[:, -1]


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the items of a column of lists."""
    values = column.combine_chunks()
    lengths = np.asarray(values.value_lengths().fill_null(0))
    return np.repeat(np.arange(len(lengths)), lengths), values.flatten().to_numpy(zero_copy_only=False)


def _lists(owner: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Lists per owner from rows that ascend by owner: the owners and a list column for each column."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    ends = pa.array(np.append(first, len(owner)).astype(np.int32))
    return owner[first], [pa.ListArray.from_arrays(ends, pa.array(c)) for c in columns]


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The ``most`` best entries of each owner, each other once; an old entry goes before a new one."""
    order = np.lexsort((fresh, other, owner))
    owner, other, score, fresh = owner[order], other[order], score[order], fresh[order]
    once = np.append(True, (owner[1:] != owner[:-1]) | (other[1:] != other[:-1]))[: len(owner)]
    owner, other, score, fresh = owner[once], other[once], score[once], fresh[once]
    order = np.lexsort((other, -score, owner))
    owner, other, score, fresh = owner[order], other[order], score[order], fresh[order]
    place = np.arange(len(owner))
    new = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
    rank = place - np.maximum.accumulate(np.where(new, place, 0)) if len(owner) else place
    kept = rank < most
    return owner[kept], other[kept], score[kept], fresh[kept]


def _with_all(best: tuple[np.ndarray, ...], all_ids: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Lists of the entries, and empty ones for ids without any."""
    ids, lists = _lists(best[0], *best[1:])
    alone = np.setdiff1d(all_ids, ids)
    if len(alone):
        ids = np.concatenate([ids, alone])
        lists = [pa.concat_arrays([x, pa.array([[]] * len(alone), x.type)]) for x in lists]
    return ids, lists


def vectors_of(table: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, with vectors of doubles."""
    rows = pick(table, id_column, column).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("vector")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = rows.where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    )
    common = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return usable.where(F.size("vector") == (common["n"] if common else 0))


def _nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[int], int]:
    """Nodes with their vectors, the same packed, rows (vec_id, node, row), the longest nodes, and the number of nodes."""
    rows = vectors.withColumn("same", F.sha2(F.to_json("vector"), 256))
    distinct = rows.groupBy("same").agg(F.first("vector").alias("vector"))
    distinct = distinct.withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)))
    nodes = settle(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    count = nodes.count()
    far = nodes.orderBy(F.desc("norm"), "node").limit(STARTS + 1).select("node", "norm").collect()
    starts, unit = [r["node"] for r in far[:STARTS]], far[-1]["norm"] if far else 1.0
    dimensions = nodes.select(F.size("vector")).first()[0] if count else 1
    signs = np.random.default_rng(17).normal(size=(DEALS, dimensions + 1, _SIGNS + 1))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.asarray(batch[1].flatten()).reshape(len(batch[1]), -1) / unit
            raw /= np.maximum(1, np.sqrt((raw * raw).sum(axis=1, keepdims=True)))
            square = np.minimum(1, (raw * raw).sum(axis=1))
            lack = square / (1 + np.sqrt(1 - square))
            # The place in each deal: signs of projections as bits, then one more projection.
            whole = np.column_stack([raw, 1 - lack])
            codes = np.empty((len(raw), DEALS))
            for d in range(DEALS):
                side = whole @ signs[d]
                codes[:, d] = (side[:, :-1] > 0) @ (1 << np.arange(_SIGNS)[::-1]) + 1 / (1 + np.exp(-side[:, -1]))
            ends = pa.array(np.arange(0, codes.size + 1, DEALS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(_pack(raw, lack), pa.binary()), pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))],
                names=["node", "packed", "codes"],
            )

    parts = -(-count // PART_NODES) or 1
    packed = settle(
        nodes.select("node", "vector").mapInArrow(pack, "node long, packed binary, codes array<double>")
        .withColumn("part", _part("node", parts)),
        "packed-vectors",
    )
    owners = rows.select("vec_id", "same").join(nodes.select("same", "node"), "same").select("vec_id", "node")
    owners = settle(owners.withColumn("row", F.monotonically_increasing_id()), "nodes-of-vectors")
    return nodes.select("node", "vector"), packed, owners, starts, count


def build(packed: DataFrame, count: int, neighbours: int = NEIGHBOURS, rounds: int = MOST_ROUNDS) -> DataFrame:
    """The graph: (part, node, nbr, score, fresh), a list of neighbours per node, best first."""
    ranges = -(-count // DEAL_NODES) or 1
    each = neighbours if ranges == 1 else neighbours // 2

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        node, part, matrix = table["node"].to_numpy(), table["part"].to_numpy(), _matrix(table["packed"])
        # A range may begin in one deal and end in the next.
        for of in (np.flatnonzero(table["deal"].to_numpy() == d) for d in np.unique(table["deal"].to_numpy())):
            most = min(each, len(of) - 1)
            for a in range(0, len(of), 512):
                mine = of[a : a + 512]
                near = _near(matrix[mine], matrix[of])
                near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
                top = np.argpartition(-near, most - 1, axis=1)[:, :most] if most > 0 else np.zeros((len(near), 0), int)
                ends = pa.array(np.arange(len(near) + 1, dtype=np.int32) * max(most, 0))
                lists = [node[of][top].ravel(), np.take_along_axis(near, top, axis=1).ravel().astype(np.float32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[mine]), pa.array(node[mine]), *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in lists]],
                    names=["part", "node", "nbr", "score"],
                )

    def combine(table: pa.Table) -> pa.Table:
        row, other = _flat(table["nbr"])
        _, score = _flat(table["score"])
        owner = table["node"].to_numpy()[row]
        best = _best(owner, other, score, np.ones(len(owner), bool), neighbours)
        ids, lists = _with_all(best, np.unique(table["node"].to_numpy()))
        part = np.full(len(ids), table["part"][0].as_py(), np.int32)
        return pa.Table.from_arrays([pa.array(part), pa.array(ids), *lists], names=["part", "node", "nbr", "score", "fresh"])

    count_of = DEALS if ranges > 1 else 1
    dealt = packed.select("part", "node", "packed", F.posexplode(F.slice("codes", 1, count_of)).alias("deal", "code"))
    dealt = dealt.repartitionByRange(ranges * count_of, "deal", "code", "node").select("part", "node", "packed", "deal")
    lists = dealt.mapInArrow(start, "part int, node long, nbr array<long>, score array<float>")
    graph = settle(lists.groupBy("part").applyInArrow(combine, _GRAPH), "graph-0")
    if ranges == 1:
        return graph
    for number in range(1, rounds + 1):
        graph = settle(_descend(graph, packed, neighbours, number), f"graph-{number}")
        changed = graph.select(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if changed < LEAST_CHANGE * neighbours * count:
            return graph
    raise RuntimeError(f"The graph still changes after {rounds} rounds.")


def _drawn(entries, number: int):
    """Up to ``SAMPLE`` of the entries, another draw in each round."""
    lots = F.transform(entries, lambda e: F.struct(F.xxhash64(e["nbr"], F.col("node"), F.lit(number)).alias("lot"), e["nbr"].alias("nbr")))
    return F.transform(F.slice(F.array_sort(lots), 1, SAMPLE), lambda e: e["nbr"])


def _descend(graph: DataFrame, packed: DataFrame, neighbours: int, number: int) -> DataFrame:
    """One round: those that a node draws, and those that drew it, are introduced to one another."""
    entries = F.arrays_zip("nbr", "fresh")
    drawn = settle(
        graph.select(
            "*",
            _drawn(F.filter(entries, lambda e: e["fresh"]), number).alias("new"),
            _drawn(F.filter(entries, lambda e: ~e["fresh"]), number).alias("old"),
        ),
        "drawn",
    )
    back = reduce(
        DataFrame.unionByName,
        [drawn.select(F.explode(c).alias("of"), F.col("node").alias("member"), F.lit(c == "new").alias("fresh")) for c in ("new", "old")],
    )
    # Of those that drew a node about SAMPLE of each kind, so no node gathers a long list.
    pointed = back.groupBy("of", "fresh").agg(F.count("*").alias("times"))
    lot = F.pmod(F.xxhash64("of", "member", F.lit(number)), F.lit(1 << 20)) / float(1 << 20)
    back = back.join(pointed, ["of", "fresh"]).where(lot * F.col("times") < SAMPLE).groupBy("of").agg(
        F.collect_set(F.when(F.col("fresh"), F.col("member"))).alias("more_new"),
        F.collect_set(F.when(~F.col("fresh"), F.col("member"))).alias("more_old"),
    )
    none = F.array().cast("array<long>")
    new = F.array_union("new", F.coalesce("more_new", none))
    old = F.array_except(F.array_union("old", F.coalesce("more_old", none)), F.col("new"))
    meetings = settle(
        drawn.join(back.withColumnRenamed("of", "node"), "node", "left")
        .withColumn("new", new).withColumn("old", old)
        .select(
            "part", F.concat("new", "old").alias("members"),
            F.concat(F.transform("new", lambda _: F.lit(True)), F.transform("old", lambda _: F.lit(False))).alias("fresh"),
        ),
        "meetings",
    )
    worst = F.when(F.size("nbr") >= neighbours, F.element_at("score", -1)).otherwise(F.lit(-9.0).cast("float"))
    known = packed.select("node", "packed", F.col("part").alias("home")).join(graph.select("node", worst.alias("worst")), "node")
    asked = meetings.select(F.col("part").alias("asking"), F.explode("members").alias("node")).distinct()
    fetched = asked.join(known, "node").select("asking", "node", "packed", "worst", "home")

    def introduce(groups: pa.Table, members: pa.Table) -> pa.Table:
        node, matrix, worst = members["node"].to_numpy(), _matrix(members["packed"]), members["worst"].to_numpy().copy()
        order = np.argsort(node)
        row, member = _flat(groups["members"])
        _, fresh = _flat(groups["fresh"])
        at = order[np.minimum(np.searchsorted(node, member, sorter=order), max(0, len(order) - 1))]
        ends = np.searchsorted(row, np.arange(len(groups) + 1))
        held = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.float32),)]
        waiting = 0
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            new = fresh[a:b].astype(bool)
            if not new.any():
                continue
            here = at[a:b]
            near = _near(matrix[here], matrix[here])
            near[here[:, None] == here] = -9
            near[~(new[:, None] | new)] = -9
            one, two = np.nonzero(near > np.maximum(worst[here], -8)[:, None])
            held.append((here[one], here[two], near[one, two]))
            waiting += len(one)
            if waiting > 2_000_000:
                held, waiting = [_best_of(held, neighbours)], 0
                # Who has found a full list here takes only what is nearer than its last.
                owner, _, score = held[0]
                last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
                full = np.diff(np.append(-1, last)) >= neighbours
                worst[owner[last[full]]] = np.maximum(worst[owner[last[full]]], score[last[full]])
        one, two, score = _best_of(held, neighbours)
        # What concerns the nodes of one part travels in one row.
        home = members["home"].to_numpy()[one]
        order = np.argsort(home, kind="stable")
        homes, lists = _lists(home[order], node[one[order]], node[two[order]], score[order])
        return pa.Table.from_arrays([pa.array(homes.astype(np.int32)), *lists], names=["home", "owner", "nbr", "score"])

    found = meetings.groupBy("part").cogroup(fetched.groupBy("asking")).applyInArrow(
        introduce, "home int, owner array<long>, nbr array<long>, score array<float>"
    )

    def merge(old: pa.Table, new: pa.Table) -> pa.Table:
        node = old["node"].to_numpy()
        order = np.argsort(node)
        row, other = _flat(old["nbr"])
        _, score = _flat(old["score"])
        _, fresh = _flat(old["fresh"])
        # What was drawn is new no more.
        new_row, was_new = _flat(old["new"])
        kinds = np.dtype([("row", np.int64), ("other", np.int64)])
        pair = lambda a, b: np.rec.fromarrays([a, b], dtype=kinds)
        fresh = fresh.astype(bool) & ~np.isin(pair(row, other), pair(new_row, was_new))
        _, new_owner = _flat(new["owner"])
        _, new_other = _flat(new["nbr"])
        _, new_score = _flat(new["score"])
        new_owner = order[np.searchsorted(node, new_owner, sorter=order)]
        fresh = np.concatenate([fresh, np.ones(len(new_owner), bool)])
        best = _best(np.concatenate([row, new_owner]), np.concatenate([other, new_other]), np.concatenate([score, new_score]), fresh, neighbours)
        ids, lists = _with_all(best, np.arange(len(node)))
        part = pa.array(np.full(len(ids), old["part"][0].as_py() if len(old) else 0, np.int32))
        return pa.Table.from_arrays([part, pa.array(node[ids]), *lists], names=["part", "node", "nbr", "score", "fresh"])

    return drawn.groupBy("part").cogroup(found.groupBy("home")).applyInArrow(merge, _GRAPH)


def _best_of(held: list, most: int) -> tuple[np.ndarray, ...]:
    one, two, score = (np.concatenate(x) for x in zip(*held, strict=True))
    return _best(one, two, score, np.zeros(len(one), bool), most)[:3]


_STATE = "part int, query long, packed binary, ids array<long>, score array<float>, seen array<boolean>, met array<long>, look array<long>"


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """A column of lists from one array per row."""
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def _rows(column: pa.ChunkedArray) -> list[np.ndarray]:
    """One array per row of a column of lists."""
    row, values = _flat(column)
    return np.split(values, np.searchsorted(row, np.arange(1, len(column)))) if len(column) else []


def _expand(state: pa.Table, lists: pa.Table) -> pa.Table:
    """What each query asks for: the lists it looks at, less what it has met."""
    node = lists["node"].to_numpy()
    listed = dict(zip(node.tolist(), _rows(lists["nbr"]), strict=True))
    asked = []
    for look, met in zip(_rows(state["look"]), _rows(state["met"]), strict=True):
        found = [listed[n] for n in look.tolist() if n in listed]
        asked.append(np.setdiff1d(np.concatenate([look, *found]), met))
    return state.append_column("ask", _column(asked, pa.int64()))


def _move(beam: int, step: int):
    def run(state: pa.Table, facts: pa.Table) -> pa.Table:
        wanted, matrix, node = _matrix(state["packed"])[:, :-1], _matrix(facts["packed"])[:, :-1], facts["node"].to_numpy()
        order = np.argsort(node)
        node = node[order]
        columns = {c: _rows(state[c]) for c in ("ids", "score", "seen", "met", "look", "ask")}
        out = {c: [] for c in ("ids", "score", "seen", "met", "look")}
        for i, vector in enumerate(wanted):
            ids, score, seen, met, look, ask = (columns[c][i] for c in ("ids", "score", "seen", "met", "look", "ask"))
            near = matrix[order[np.searchsorted(node, ask)]] @ vector if len(ask) else np.zeros(0, np.float32)
            ids, score = np.concatenate([ids, ask]).astype(np.int64), np.concatenate([score, near]).astype(np.float32)
            seen = np.concatenate([seen.astype(bool), np.isin(ask, look)])
            best = np.lexsort((ids, -score))[:beam]
            ids, score, seen = ids[best], score[best], seen[best]
            following = np.flatnonzero(~seen)[:step]
            seen[following] = True
            for c, x in zip(out, (ids, score, seen, np.concatenate([met, ask]), ids[following]), strict=True):
                out[c].append(x)
        kinds = {"ids": pa.int64(), "score": pa.float32(), "seen": pa.bool_(), "met": pa.int64(), "look": pa.int64()}
        arrays = [*[state[c] for c in ("part", "query", "packed")], *[_column(out[c], k) for c, k in kinds.items()]]
        return pa.Table.from_arrays(arrays, names=["part", "query", "packed", *kinds])

    return run


def walk(graph: DataFrame, packed: DataFrame, queries: DataFrame, starts: list[int], rounds: int = MOST_ROUNDS, beam: int = BEAM, step: int = STEP) -> DataFrame:
    """(query, nodes): the nearest nodes that greedy search finds, best first.

    ``queries`` has query (an id), packed (its vector) and node,
    which it begins at beside ``starts``; that may be null.
    """
    parts = queries.count() // QUERIES_PER_PART + 1
    first = F.array_distinct(F.array_compact(F.concat(F.array("node"), F.array(*[F.lit(x) for x in starts]).cast("array<long>"))))
    none = [F.array().cast(f"array<{kind}>").alias(c) for c, kind in (("ids", "long"), ("score", "float"), ("seen", "boolean"), ("met", "long"))]
    state = settle(queries.select(_part("query", parts).alias("part"), "query", "packed", *none, first.alias("look")), "walk-0")
    vectors = packed.select("node", "packed")
    for number in range(1, rounds + 1):
        looked = state.select(F.col("part").alias("asking"), F.explode("look").alias("node")).distinct()
        lists = looked.join(graph.select("node", "nbr"), "node").select("asking", "node", "nbr")
        asking = settle(state.groupBy("part").cogroup(lists.groupBy("asking")).applyInArrow(_expand, f"{_STATE}, ask array<long>"), "asking")
        wanted = asking.select(F.col("part").alias("asking"), F.explode("ask").alias("node")).distinct()
        facts = wanted.join(vectors, "node").select("asking", "node", "packed")
        state = settle(asking.groupBy("part").cogroup(facts.groupBy("asking")).applyInArrow(_move(beam, step), _STATE), f"walk-{number}")
        if state.where(F.size("look") > 0).isEmpty():
            return state.select("query", F.col("ids").alias("nodes"))
    raise RuntimeError(f"Queries still have nodes to look at after {rounds} rounds.")


def nearest(table: DataFrame, wanted, k: int = 20, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row that fulfils ``wanted`` (of vec_id).

    Every row but the query's own is a candidate; ties go to the smaller vec_id.
    """
    vectors = settle(vectors_of(table, id_column, column), "usable-vectors")
    nodes, packed, owners, starts, count = _nodes(vectors)
    graph = build(packed, count)
    asking = owners.where(wanted)
    queries = packed.join(asking.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("query"), "packed", "node")
    found = walk(graph, packed, queries, starts, beam=max(BEAM, 2 * k))
    longest = F.array(*[F.lit(x) for x in starts]).cast("array<long>")
    reached = found.select("query", F.explode(F.array_distinct(F.concat("nodes", F.array("query"), longest))).alias("node"))
    scored = (
        reached.join(nodes.withColumnRenamed("vector", "x"), "node")
        .join(nodes.withColumnsRenamed({"node": "query", "vector": "y"}), "query")
        .select("query", "node", F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b).alias("score"))
    )
    # Rows with equal vectors: as many of the smallest ids as an answer can hold beside the query itself.
    members = settle(
        owners.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("vec_id", "row")))
        .where(F.col("place") <= k + 1).select("node", "vec_id", F.col("row").alias("other")),
        "members",
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "other")
    rows = scored.join(members, "node").withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    rows = rows.select("query", "vec_id", "other", "score")
    answers = asking.withColumnsRenamed({"vec_id": "query_id", "node": "query"}).join(rows, "query").where("row <> other")
    final = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "other")
    return answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
