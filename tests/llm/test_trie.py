"""The prefix trie of conversations against a plain trie, with short segments and blocks."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from meterlab.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, ROLE string, key string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute(sequences):
    """Nodes as sets of the columns, from a dictionary of all prefixes."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    rows = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = sum(len(p) == len(prefix) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * words(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        rows.append((min(convs), len(prefix), parent, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def table(spark, sequences):
    rows = [(c, i, r, t, "x", "y") for c, turns in sequences.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def found(nodes):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in nodes.select(*names).collect()), key=str)


def made(seed, count, longest):
    draw = random.Random(seed)
    sequences = {}
    for c in range(count):
        base = list(sequences[draw.randrange(c) * 7 - 20]) if c and draw.random() < 0.7 else []
        turns = base[: draw.randrange(len(base) + 1)]
        turns += [("ab"[draw.randrange(2)], "w " * draw.randrange(3)) for _ in range(draw.randrange(longest))]
        sequences[c * 7 - 20] = turns
    # Some that are alike or go on from each other.
    first = max(sequences.values(), key=len)
    for c in range(1000, 1012):
        sequences[c] = first[: len(first) - c % 3]
    return sequences


@pytest.mark.parametrize(("segment", "longest"), [(1, 4), (2, 5), (3, 9), (256, 6)])
def test_nodes(spark, segment, longest):
    sequences = made(segment, 60, longest)
    turns = prefix_trie.turns_of(table(spark, sequences))
    lengths = spark.createDataFrame([(c, len(t)) for c, t in sequences.items()], "conv_id long, n long")
    assert found(prefix_trie.trie(turns, lengths, segment, block_turns=9)) == brute(sequences)


def test_heads(spark):
    sequences = made(5, 40, 4)
    sequences = {c + 20: t for c, t in sequences.items() if t}
    df = table(spark, sequences)
    conv = F.col("conv_id")
    turns, lengths = prefix_trie.with_heads(prefix_trie.turns_of(df), conv - conv % 20, conv % 4 * (conv > 0).cast("int"), 3)
    expected = {}
    for c, own in sequences.items():
        h = c % 4 if c > 0 else 0
        expected[c] = list(sequences.get(c - c % 20, []))[:h] + own[h:]
    assert found(prefix_trie.trie(turns, lengths)) == brute(expected)


def test_hot_conversation(spark):
    """One conversation of a third of all rows, cut into many segments."""
    sequences = {1: [("user", f"t {i}") for i in range(300)], 2: [("user", f"t {i}") for i in range(150)], 3: [("user", "t 0")], 4: [("user", "t 0")]}
    turns = prefix_trie.turns_of(table(spark, sequences))
    lengths = spark.createDataFrame([(c, len(t)) for c, t in sequences.items()], "conv_id long, n long")
    assert found(prefix_trie.trie(turns, lengths, segment=16, block_turns=40)) == brute(sequences)


def test_edges(spark):
    rows = [
        (1, None, None, None, "x", "y"), (1, 0, "user", "", "x", "y"), (1, 0, "user", "", "x", "y"), (None, 0, "user", "a", "x", "y"),
        (2, 0, "", "", "x", "y"), (3, 1, "user", "퟿ " * 20000, "x", "y"),
    ]
    nodes = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    lengths = nodes.groupBy("conv_id").agg(F.max("place").alias("n"))
    sequences = {1: [("", ""), ("user", ""), ("user", "")], 2: [("", "")], 3: [("user", "퟿ " * 20000)]}
    assert found(prefix_trie.trie(nodes, lengths)) == brute(sequences)
    none = spark.createDataFrame([], SCHEMA)
    turns = prefix_trie.turns_of(none)
    assert prefix_trie.trie(turns, turns.groupBy("conv_id").agg(F.max("place").alias("n"))).count() == 0
