"""Document fingerprints by content-defined chunking.

A gear hash runs over the bytes of a text: each byte shifts it left by one and adds
a random number of its own, so that it depends on the last 32 bytes. A chunk ends
where the hash has zeros in certain bits. Chunking is normalised: a chunk shorter
than ``NORMAL`` bytes needs more zeros and a longer one fewer, none is shorter than
``LEAST``, and one of ``MOST`` bytes ends anyway. Boundaries follow the content, so
after an insertion or deletion they fall into step again.

A fingerprint is the set of the digests of a text's chunks with their lengths, as
base64 of ten bytes per chunk (64-bit digest, 16-bit length) in ascending order.
Chunks are weighted by length: the likeness of a to b is the share of a's distinct
chunks, by length, that b has too. It is 1 for equal texts; a text without bytes has
an empty fingerprint, which is like another empty one only.

Null texts are empty. For :func:`with_next` documents stand in the order of doc_id,
null first, and then of a hash of their text; the last is followed by the first. Repeated rows
follow one another. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from meterlab.llm.text import pick, seeded
from meterlab.plans.blocks import settle

LEAST, NORMAL, MOST = 12, 40, 192
STRICT_BITS, LOOSE_BITS = 6, 4
# Documents in a block that one task puts in order.
BLOCK_BYTES = 32 << 20

_GEAR = (seeded(256, 99) >> np.uint64(32)).astype(np.uint32)
_STRICT = np.uint32(((1 << STRICT_BITS) - 1) << (32 - STRICT_BITS))
_LOOSE = np.uint32(((1 << LOOSE_BITS) - 1) << (32 - LOOSE_BITS))
_CHUNK = np.dtype([("digest", ">u8"), ("length", ">u2")])


def boundaries(raw: bytes) -> list[int]:
    """Where chunks end."""
    size = len(raw)
    h = _GEAR[np.frombuffer(raw, np.uint8)]
    span = 1
    while span < 32 and span < size:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, 2 * span
    loose = np.flatnonzero((h & _LOOSE) == 0)
    strict = (loose[(h[loose] & _STRICT) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    ends, start = [], 0
    while size - start > LEAST:
        end = min(start + MOST, size)
        k = bisect_left(strict, start + LEAST)
        if k < len(strict) and strict[k] < start + NORMAL:
            end = min(end, strict[k])
        else:
            k = bisect_left(loose, start + NORMAL)
            if k < len(loose):
                end = min(end, loose[k])
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def chunk_table(raw: bytes) -> np.ndarray:
    """Distinct chunks, ascending, with their lengths."""
    start, found = 0, {}
    for end in boundaries(raw):
        part = raw[start:end]
        found[xxhash.xxh3_64_intdigest(part)] = end - start
        start = end
    return np.array(sorted(found.items()), _CHUNK) if found else np.zeros(0, _CHUNK)


def encode(table: np.ndarray) -> str:
    return base64.b64encode(table.tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), _CHUNK)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's chunks, by length, that b contains."""
    total = int(a["length"].sum(dtype=np.int64))
    if not total:
        return float(not len(b))
    shared = np.isin(a["digest"].astype(np.uint64), b["digest"].astype(np.uint64), assume_unique=True)
    return float(a["length"][shared].sum(dtype=np.int64)) / total


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every whole text, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [encode(chunk_table((t.as_py() or "").encode())) for t in batch[1]]
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document beside an edited text and the document after it.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. Blocks of neighbouring ids are put in order by one
    task each; the first document of a block also goes to the block before it. Texts
    are shuffled once, compressed.
    """
    docs = pick(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text"))
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    found = sizes.agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    if not found["rows"]:
        count = 1
    else:
        count = int(found["bytes"]) // block_bytes + 1
    # Where blocks begin, and the very first document: a few numbers per block.
    ranged = sizes.select("doc_id").repartitionByRange(count, "doc_id")
    cuts = settle(
        ranged.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.min("doc_id").alias("low")), "block-starts"
    )
    lows = np.unique(np.array([r["low"] for r in cuts.select("low").where("low is not null").collect()], np.int64))
    edges = lows[1:]
    last = len(edges)
    smallest = np.iinfo(np.int64).min

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their block; those of a block's first id go to the block before it too."""
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            null = np.asarray(batch[0].is_null())
            ids = batch[0].fill_null(smallest).to_numpy()
            block = np.where(null, 0, np.searchsorted(edges, ids, "right"))
            first = np.zeros(len(ids), bool)
            if len(lows):
                first = (ids == lows[np.minimum(block, len(lows) - 1)]) & ~null
            # Ids that repeat, and null ones, are first together; all of them are helpers.
            first |= null
            first_low = null if has_null else first
            first = np.where(block == 0, first_low, first)
            rows = np.concatenate([np.arange(len(ids)), np.flatnonzero(first)])
            where = np.concatenate([block, np.where(block[first] == 0, last, block[first] - 1)])
            helper = np.concatenate([np.zeros(len(ids), bool), np.ones(int(first.sum()), bool)])
            at = pa.array(rows)
            packed = pa.array([compress((t.as_py() or "").encode()) for t in batch[1]], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(where.astype(np.int32)), pa.array(helper), *[c.take(at) for c in (batch[0], batch[2], packed)]],
                names=["block", "helper", "doc_id", "tie", "packed"],
            )

    has_null = bool(found["rows"]) and not sizes.where("doc_id is null").isEmpty()
    dealt = docs.mapInArrow(deal, "block int, helper boolean, doc_id long, tie long, packed binary")
    # More partitions than blocks, so that few of them get two.
    ordered = dealt.repartition(3 * last + 1, "block").sortWithinPartitions(
        "block", "helper", F.col("doc_id").asc_nulls_first(), "tie"
    ).drop("tie")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # the document whose next one is not known yet: block, id, text, chunks

        def finish(doc: tuple, text: str, table: np.ndarray) -> tuple:
            _, doc_id, own, chunk = doc
            raw = _edited(own, text).encode()
            edited = chunk_table(raw)
            return (
                doc_id, len(own), hashlib.sha256(raw).hexdigest(), encode(chunk), encode(edited),
                likeness(chunk, edited), likeness(chunk, table),
            )

        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for block, helper, doc_id, packed in zip(*batch.columns, strict=True):
                block, helper = block.as_py(), helper.as_py()
                if helper and before is None:
                    continue
                raw = expand(packed.as_py())
                own, table = raw.decode(), chunk_table(raw)
                if before is not None:
                    out.append(finish(before, own, table))
                before = None if helper else (block, doc_id.as_py(), own, table)
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
