"""Line dedup by pairwise alignment.

Texts are cut into lines, and lines into sentences of at least ``SHORT_SENTENCE`` words,
since passages are often quoted inside a line; below, both are called lines. A line is compared
without regard to A-Z and white space, by a 64-bit hash.

What is looked for are windows: runs of adjacent lines with at least ``least_words`` words,
of which either the last or the first line could not be spared. Every run of adjacent lines
of so many words that two documents share is made up of such windows that they share. A
window belongs to the document with the smallest doc_id that has it, and every later one
that repeats it forms a pair with that owner. There are no more pairs than repeated
windows, so one in a third of all documents makes one pair per document and not one for
every two; shorter lines that are found everywhere make none and part no passage. Each
pair is aligned as patience diff does: windows that are found once in both, in the longest
run that ascends in both, and then the same between them; where there are none of these,
the k-th occurrence goes with the k-th. The lines of aligned windows are deleted from the
later document.

Null texts stay null. Rows with a null doc_id have no place in the order and are
left alone. Rows that share a doc_id are one document for the order: they are
not compared with each other, and each loses what an earlier document has. An
empty table gives no rows; other columns stay as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterlab.llm.text import Chunk, Splitter, by_space, chunks, mix, seeded
from meterlab.plans.blocks import settle, settled

LEAST_WORDS = 8
SHORT_SENTENCE = 5
_PLACES = 1021


def _units(chunk: Chunk, split: Splitter) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, byte after the last, words, hash) of each line or sentence, in order."""
    words, data = split(chunk), chunk.data
    count = len(words.start)
    if not count:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    lines = np.append(0, np.cumsum(data == 0x0A))
    ends_line = np.ones(count, bool)
    same_row = words.row[1:] == words.row[:-1]
    ends_line[:-1] = ~same_row | (lines[words.start[1:]] != lines[words.stop[:-1]])
    final = data[words.stop - 1]
    marks = (final == ord(".")) | (final == ord("!")) | (final == ord("?"))
    cuts = np.flatnonzero(ends_line | marks)
    # A short sentence goes with the next one of its line.
    cuts = cuts[(np.diff(np.append(-1, cuts)) >= SHORT_SENTENCE) | ends_line[cuts]]
    first = np.append(0, cuts[:-1] + 1)
    sizes = cuts - first + 1
    place = (np.arange(count) - np.repeat(first, sizes)) % _PLACES
    hashes = mix(np.add.reduceat(words.hash * seeded(_PLACES, 3)[place], first))
    return words.row[first], words.start[first], words.stop[cuts], sizes, hashes


def _windows(row: np.ndarray, words: np.ndarray, hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first line, last line, hash) of the windows of all rows, in order."""
    count = len(row)
    none = np.zeros(0, np.int64)
    if not count:
        return none, none, none.astype(np.uint64)
    total = np.append(0, np.cumsum(words))
    each = np.arange(count)
    ends = np.searchsorted(total, total[:-1] + least) - 1
    begins = np.searchsorted(total, total[1:] - least, "right") - 1
    first, last = np.concatenate([each, begins]), np.concatenate([ends, each])
    inside = (first >= 0) & (last < count)
    first, last = first[inside], last[inside]
    inside = row[first] == row[last]
    if not inside.any():
        return none, none, none.astype(np.uint64)
    first, last = np.unique(np.column_stack([first[inside], last[inside]]), axis=0).T
    sizes = last - first + 1
    starts = np.append(0, np.cumsum(sizes)[:-1])
    place = np.arange(sizes.sum()) - np.repeat(starts, sizes)
    terms = hashes[np.repeat(first, sizes) + place] * seeded(_PLACES, 29)[place % _PLACES]
    keys = mix(np.add.reduceat(terms, starts) + sizes.astype(np.uint64))
    return first, last, keys


def _repeats(row: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys their row has had before."""
    order = np.lexsort((np.arange(len(row)), keys, row))
    again = np.zeros(len(row), bool)
    again[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (keys[order[1:]] == keys[order[:-1]])
    return again


def window_table(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, tag, place, first, last, again, key) of every window; ``docs`` has doc_id, tag and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = by_space()
        for batch in batches:
            for chunk in chunks(batch[2]):
                row, _, _, words, hashes = _units(chunk, split)
                head = np.searchsorted(row, np.arange(chunk.rows))
                first, last, keys = _windows(row, words, hashes, least_words)
                owner = row[first]
                each = np.bincount(owner, minlength=chunk.rows)
                place = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(each)[:-1]), each)
                at = pa.array(owner + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch[0].take(at),
                        batch[1].take(at),
                        pa.array(place.astype(np.int32)),
                        pa.array((first - head[owner]).astype(np.int32)),
                        pa.array((last - head[owner]).astype(np.int32)),
                        pa.array(_repeats(owner, keys)),
                        pa.array(keys.view(np.int64)),
                    ],
                    names=["doc_id", "tag", "place", "first", "last", "again", "key"],
                )

    return docs.mapInArrow(run, "doc_id long, tag long, place int, first int, last int, again boolean, key long")


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, which ascend by their first place, that ascend by the second too."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, place) in enumerate(pairs):
        k = bisect_left(tails, place)
        before[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(place)
            at.append(i)
        else:
            tails[k], at[k] = place, i
    run = []
    i = at[-1] if at else -1
    while i >= 0:
        run.append(pairs[i])
        i = before[i]
    return run[::-1]


def _aligned(mine: list[int], theirs: list[int]) -> list[int]:
    """Places in ``mine`` that patience diff aligns with places in ``theirs``."""
    out: list[int] = []
    left = [(0, len(mine), 0, len(theirs))]
    while left:
        a, b, c, d = left.pop()
        while a < b and c < d and mine[a] == theirs[c]:
            out.append(a)
            a, c = a + 1, c + 1
        while a < b and c < d and mine[b - 1] == theirs[d - 1]:
            b, d = b - 1, d - 1
            out.append(b)
        if a == b or c == d:
            continue
        where: dict[int, list[int]] = {}
        for j in range(c, d):
            where.setdefault(theirs[j], []).append(j)
        seen: dict[int, list[int]] = {}
        for i in range(a, b):
            seen.setdefault(mine[i], []).append(i)
        both = [(own, where[key]) for key, own in seen.items() if key in where]
        once = [(own[0], other[0]) for own, other in both if len(own) == len(other) == 1]
        run = _ascending(sorted(once or [x for own, other in both for x in zip(own, other, strict=False)]))
        out += [i for i, _ in run]
        for i, j in [*run, (b, d)] if run else []:
            if a < i and c < j:
                left.append((a, i, c, j))
            a, c = i + 1, j + 1
    return out


def _align(common: DataFrame) -> DataFrame:
    """(doc_id, tag, gone): the deleted lines of each document that has some."""
    ordered = common.repartition("doc_id", "tag").sortWithinPartitions("doc_id", "tag", "owner", "owner_tag", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(doc: tuple, pairs: dict[tuple, dict[int, tuple]]) -> tuple:
            gone: set[int] = set()
            for windows in pairs.values():
                rows = list(windows.values())
                theirs = sorted((j, key) for _, _, key, others in rows for j in others or ())
                for i in _aligned([r[2] for r in rows], [key for _, key in theirs]):
                    gone.update(range(rows[i][0], rows[i][1] + 1))
            return *doc, sorted(gone)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            ids, tags, gone = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(tags, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
                names=["doc_id", "tag", "gone"],
            )

        now, pairs = None, {}
        for batch in batches:
            done = []
            for doc_id, tag, owner, owner_tag, place, *window in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (doc_id, tag) != now:
                    if now:
                        done.append(finish(now, pairs))
                    now, pairs = (doc_id, tag), {}
                # Rows that are equal throughout have each window several times.
                pairs.setdefault((owner, owner_tag), {})[place] = window
            yield batch_of([d for d in done if d[2]])
        if now:
            yield batch_of([d for d in [finish(now, pairs)] if d[2]])

    return ordered.select("doc_id", "tag", "owner", "owner_tag", "place", "first", "last", "key", "others").mapInArrow(
        run, "doc_id long, tag long, gone array<int>"
    )


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the spans, and without the white space or line end that set them off."""
    kept, at = [], 0
    for start, stop in spans:
        opens = start == 0 or text[start - 1] == 0x0A
        closes = stop == len(text) or text[stop] == 0x0A
        if opens and closes:
            if stop < len(text):
                stop += 1
            elif start > at:
                start -= 1
        elif opens:
            while stop < len(text) and text[stop] in b" \t":
                stop += 1
        else:
            while start > at and text[start - 1] in b" \t":
                start -= 1
        kept.append(text[at:start])
        at = stop
    kept.append(text[at:])
    return b"".join(kept)


def _gone(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, tag, gone): the lines that go from each document (doc_id, tag, text)."""
    windows = settle(window_table(docs, least_words), "windows")
    owners = settle(
        windows.groupBy("key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last_id"))
        .where("owner < last_id").select("key", "owner"),
        "window-owners",
    )
    repeated = settle(windows.join(owners, "key"), "repeated-windows")
    # Of an owner's texts the one with the smallest tag; its places go with the first occurrence in the later document.
    heads = (
        repeated.where("doc_id = owner").groupBy("key", "tag").agg(F.collect_set("place").alias("others"))
        .groupBy("key").agg(F.min("tag").alias("owner_tag"), F.min_by("others", "tag").alias("others"))
    )
    common = repeated.where("doc_id > owner").join(heads, "key").withColumn("others", F.when(~F.col("again"), F.col("others")))
    return _align(common)


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents without the blocks that earlier ones have.

    All columns stay; ``text`` is replaced, and ``lines_removed`` and
    ``words_removed`` (bigint) are added, always last. Where the documents have a column of
    such a name, in any case, underscores are added to the new one until it differs from all.
    """
    names, ids = list(docs.columns), [f"_{i}" for i in range(len(docs.columns))]
    taken, added = {n.lower() for n in names}, []
    for name in ("lines_removed", "words_removed"):
        while name in taken:
            name += "_"
        added.append(name)
    doc_id, text = (f"_{names.index(n)}" for n in ("doc_id", "text"))
    plain = docs.toDF(*ids).withColumn("tag", F.xxhash64(text))
    known = plain.where(F.col(doc_id).isNotNull())
    given = known.select(F.col(doc_id).alias("doc_id"), "tag", F.col(text).alias("text"))
    # Only what goes is kept; the tables of windows that led to it are deleted.
    gone = settled(lambda: _gone(given, least_words), "lines-gone")
    right = gone.withColumnsRenamed({"doc_id": "gone_id", "tag": "gone_tag"})
    met = plain.join(
        right,
        (F.col(doc_id) == F.col("gone_id")) & (F.col("tag") == F.col("gone_tag")),
        "left",
    ).drop("gone_id", "gone_tag", "tag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = by_space()
        for batch in batches:
            column, removed = batch[text], batch["gone"]
            texts = column.to_pylist()
            counts = np.zeros((2, len(texts)), np.int64)
            for i in np.flatnonzero(np.asarray(removed.is_valid())).tolist():
                chunk = next(chunks(column.slice(i, 1)))
                _, start, stop, words, _ = _units(chunk, split)
                out = removed[i].as_py()
                counts[0, i], counts[1, i] = len(out), words[out].sum()
                spans: list[tuple[int, int]] = []
                for k, unit in enumerate(out):
                    if k and unit == out[k - 1] + 1:
                        spans[-1] = (spans[-1][0], int(stop[unit]))
                    else:
                        spans.append((int(start[unit]), int(stop[unit])))
                texts[i] = _without(chunk.data.tobytes(), spans).decode()
            arrays = [pa.array(texts, pa.string()) if c == text else batch[c] for c in ids]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(counts[0]), pa.array(counts[1])], names=[*ids, "lines_removed", "words_removed"]
            )

    kinds = ", ".join(f"{c} {t}" for c, t in docs.toDF(*ids).dtypes)
    out = met.mapInArrow(run, f"{kinds}, lines_removed long, words_removed long")
    return out.toDF(*names, *added)
