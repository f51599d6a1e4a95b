"""Words of whole Arrow batches, found and hashed with numpy.

A batch of texts is one run of bytes. Words are found by a table that says which
byte belongs to a word, and each word's hash is a sum over its bytes, so that no
Python code runs per word. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Bytes of text that are worked on at a time; a longer text is worked on alone.
CHUNK = 2 << 20
_POWERS = 4093


class Chunk(NamedTuple):
    """Rows ``first`` onwards of a batch: their bytes and where each row begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """The words of a chunk in order: row, first byte, byte after the last, hash."""

    row: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by their exact names, also where others differ from them in case only."""
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[F.col(f"`{n}`") for n in names])
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{df.columns.index(n)}").alias(n) for n in names])


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """Cut a column of texts into runs of rows of about ``size`` bytes; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    count = len(texts)
    if not count:
        return
    _, where, what = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + count + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), count)
        part = offsets[first : last + 1]
        yield Chunk(first, data[part[0] : part[-1]], part - part[0])
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(count: int, seed: int) -> np.ndarray:
    """``count`` random odd 64-bit numbers, the same everywhere."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Splitter:
    """Finds the words of chunks.

    ``letters`` are the bytes that belong to words; all others part them.
    A-Z count as a-z.
    """

    def __init__(self, letters: np.ndarray):
        self.inside = letters
        values = seeded(256, 7)
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
        self.values = np.where(letters, values, np.uint64(0))
        self.powers = seeded(_POWERS, 11)

    def __call__(self, chunk: Chunk) -> Words:
        data, offsets = chunk.data, chunk.offsets
        inside = self.inside[data]
        before = np.empty(len(data) + 1, bool)
        before[0], before[1:] = False, inside
        edges = offsets[1:-1]
        begins = inside & ~before[:-1]
        cut = edges[edges < len(data)]
        begins[cut] = inside[cut]
        start = np.flatnonzero(begins)
        if not len(start):
            none = np.zeros(0, np.int64)
            return Words(none, none, none, np.zeros(0, np.uint64))
        row = np.searchsorted(offsets, start, "right") - 1
        spans = np.diff(np.append(start, len(data)))
        first_edge = int(start[0])
        place = np.arange(len(data) - first_edge, dtype=np.int32)
        place -= np.repeat((start - first_edge).astype(np.int32), spans)
        np.remainder(place, _POWERS, out=place)
        terms = self.values[data[first_edge:]] * self.powers[place]
        hashes = mix(np.add.reduceat(terms, start - first_edge))
        length = np.add.reduceat(inside[first_edge:].astype(np.int32), start - first_edge)
        # A span holds one word and what parts it from the next, so all its letters are the word's.
        return Words(row, start, start + length, hashes)


    def prefixes(self, chunk: Chunk, words: Words, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of the first bytes, of each of the lengths, of all words that are longer."""
        row, start, size = words.row, words.start, words.stop - words.start
        total = np.zeros(len(start), np.uint64)
        rows, hashes = [row[:0]], [total[:0]]
        for i in range(max(lengths)):
            longer = size > i + 1
            row, start, size, total = row[longer], start[longer], size[longer], total[longer]
            total = total + self.values[chunk.data[start + i]] * self.powers[i]
            if i + 1 in lengths:
                rows.append(row)
                hashes.append(mix(total ^ np.uint64(i + 1)))
        return np.concatenate(rows), np.concatenate(hashes)


def by_space() -> Splitter:
    """Words are runs of anything but ASCII white space."""
    letters = np.ones(256, bool)
    letters[[0x20, *range(0x09, 0x0E)]] = False
    return Splitter(letters)


def by_letters() -> Splitter:
    """Words are runs of ASCII letters and digits and of all bytes beyond ASCII."""
    letters = np.zeros(256, bool)
    for a, b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        letters[a : b + 1] = True
    return Splitter(letters)


def distinct_shingles(words: Words, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of ``size`` words, by row and hash.

    A row with fewer words has its whole sequence as its only shingle, a row
    without words has none.
    """
    count = np.bincount(words.row, minlength=rows)
    weights = seeded(size, 23)
    h, n = words.hash, max(0, len(words.hash) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += h[i : i + n] * weights[i]
    whole = words.row[:n] == words.row[size - 1 : size - 1 + n]
    row, value = words.row[:n][whole], mix(total[whole])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(words.row, short)
        sums = [
            (h[a : a + c] * weights[:c]).sum(dtype=np.uint64) + np.uint64(c)
            for a, c in zip(first, count[short], strict=True)
        ]
        row = np.concatenate([row, short])
        value = np.concatenate([value, mix(np.array(sums, np.uint64))])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]
