"""Best-fit packing of token sequences by hierarchical residual packing.

Documents are cut into pieces of at most ``capacity`` tokens. The tasks that
read them pack their own pieces: longest first, each into the fullest bin that
still takes it. Bins that are nearly full are final. What is left goes up a tree:
a bin that is at most half full goes up as one item; of a fuller bin, which no
other such bin could join, each piece goes up as an item. The rows of ``fan_in``
groups meet, are packed the same way, emit their nearly full bins and pass on the
rest, until one group is left.

Only rows of piece numbers move, never texts, and only those of underfull bins.
A level has as many groups as keep them at about ``group_rows`` rows each. If these are
more than the tree would have, bins are dealt to groups by hash, so that rows from all
parts of the table meet, and that is repeated while the number of bins falls.

Null texts are empty and become the end token alone. Rows that repeat are packed
like any others; ties in length are broken by the order of rows in a task. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from meterlab.llm.text import pick
from meterlab.plans.blocks import settle

CAPACITY = 2048
# A bin with so many parts of a hundred of the capacity is nearly full.
FULL_PERCENT = 99
FAN_IN = 32
GROUP_ROWS = 2_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long, done boolean, part int"


def encoder(path: str | None = None):
    """Tokenizer from a file of ranks; its ids are those of ``byte_bpe_50k.json``.

    Both files hold one vocabulary. The added tokens that the JSON file beside the ranks
    lists, such as ``<|endoftext|>``, are found in texts and have their own ids.
    """
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    added, beside = {}, path.removesuffix(".tiktoken") + ".json"
    if os.path.exists(beside):
        with open(beside, encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins; longest first, fullest bin that fits.

    Open bins are kept by the room they have left, with one bit for each amount
    of room that some bin has, so that a placement takes constant time.
    """
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, number, bins = capacity, bins, bins + 1
        where[i], offset[i] = number, capacity - room
        room -= size
        if room:
            if not by_room[room]:
                rooms |= 1 << room
            by_room[room].append(number)
    return where, offset, bins


def pieces_of(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document's tokens are its ids and then id 0. Longer ones are cut into
    pieces of ``capacity`` tokens, the first of which may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        added = own.special_tokens_set
        for batch in batches:
            docs, numbers, starts, lengths, sums = [], [], [], [], []
            for doc, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                plain = text.as_py() or ""
                ids = own.encode(plain, allowed_special=added) if any(t in plain for t in added) else own.encode_ordinary(plain)
                ids.append(0)
                raw = np.array(ids, "<u4").tobytes()
                ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity)
                for number, end in enumerate(ends):
                    start = max(0, end - capacity)
                    start = 0 if number == 0 else start
                    docs.append(doc)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(end - start)
                    sums.append(zlib.crc32(raw[4 * start : 4 * end]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(cut, _PIECES)


def _fill(rows: pd.DataFrame, items: np.ndarray, inner: np.ndarray, head: int, part: int, capacity: int, full: int) -> pd.DataFrame:
    """Pack items, of which rows are parts at place ``inner``; ``head`` makes ids unique."""
    sizes = np.bincount(items, weights=rows["length"].to_numpy()).astype(np.int64)
    where, offset, bins = best_fit(sizes, capacity)
    fill = np.bincount(where, weights=sizes, minlength=bins)
    return rows.assign(
        sequence_id=head + where[items],
        offset=offset[items] + inner,
        done=fill[where[items]] >= full,
        part=np.int32(part),
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, full_percent: int = FULL_PERCENT, fan_in: int = FAN_IN, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Give each piece its sequence and its place there (``sequence_id``, ``offset``)."""
    full = -(-capacity * full_percent // 100)

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*frames, pd.DataFrame()])
        if len(rows):
            part = TaskContext.get().partitionId()
            each = np.arange(len(rows))
            yield _fill(rows, each, np.zeros(len(rows), np.int64), part << 32, part, capacity, full)

    def merged(round_number: int):
        def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            part = int(key[0])
            rows = rows.drop(columns=["group"])
            rows = rows.sort_values(["sequence_id", "offset"], kind="stable", ignore_index=True)
            _, bins = np.unique(rows["sequence_id"].to_numpy(), return_inverse=True)
            length, offset = rows["length"].to_numpy(), rows["offset"].to_numpy()
            whole = (np.bincount(bins, weights=length) * 2 <= capacity)[bins]
            first = np.zeros(len(rows), bool)
            first[0] = True
            first[1:] = (bins[1:] != bins[:-1]) | ~whole[1:]
            items = np.cumsum(first) - 1
            head = (round_number << 56) + (part << 32)
            return _fill(rows, items, np.where(whole, offset, 0), head, part, capacity, full)

        return merge

    level = settle(pieces.mapInPandas(local, _PACKED), "packed")
    out = level.where("done")
    left = level.where("not done")
    # The first row of a bin stands for it.
    sizes = F.count_if(F.expr("offset = 0")).alias("bins"), F.count_if(F.expr("offset = 0 and not done")).alias("open"), F.count_if(F.expr("not done")).alias("rows")
    found = level.agg(*sizes, F.max("part").alias("last")).first()
    groups, number = (found["last"] or 0) + 1, 0
    rows, bins = found["rows"], found["open"]
    while groups > 1:
        tree, least, number = -(-groups // fan_in), -(-rows // group_rows), number + 1
        dealt = least > tree
        groups = max(tree, least)
        by = F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(groups)) if dealt else F.floor(F.col("part") / fan_in)
        grouped = left.withColumn("group", by.cast("int"))
        level = settle(
            grouped.groupBy("group").applyInPandas(merged(number), _PACKED), f"packed-{number}"
        )
        found = level.agg(*sizes).first()
        if dealt and found["bins"] >= bins:
            break
        out, left = out.unionByName(level.where("done")), level.where("not done")
        rows, bins = found["rows"], found["open"]
    return out.unionByName(left).drop("done", "part")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequences: :func:`pieces_of`, then :func:`pack`."""
    return pack(pieces_of(docs, tokenizer, capacity), capacity)
