"""Secrets in texts: fixed patterns, and a linear-chain conditional random field beside them.

Texts are cut into tokens: runs of letters, digits, underscores and bytes beyond ASCII, and
every other sign but white space by itself. The field tags tokens as begin of a secret,
inside or outside, from the token's shape (length, kinds of signs, changes between
them), the words beside it, and what the whole text is like. Weights lie in a table of
``2 ** BITS`` rows by hash of the feature, three tags each, with a weight per pair of neighbouring tags.

It learns from what the patterns find: windows of ``WINDOW`` tokens about a span, and
windows about a token with digits where there is none. ``sample_rows`` bounds the texts of
each kind; those with the smallest hashes are taken, a repeated text once. By the hash, a
quarter of the windows hides the words beside the tokens, a quarter the exact shapes, and a quarter both, so
that a secret of another length or with another keyword is known by what is left.

Decoding is exact: Viterbi over whole texts. A token whose score for outside leads by more than all transitions
around it could make up for is outside on every best path; it parts a text into runs, and these are
decoded all at once. What the field finds is added where no pattern's span overlaps it.

A null text is empty and has no span; positions count code points. Rows keep their ids, also null or
repeated ones. An empty table gives no rows; other columns are not read. Without any span to learn
from, patterns alone are used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from meterlab.llm.text import Chunk, chunks, mix, pick, seeded
from meterlab.plans.blocks import settle

# Fixed patterns: a value given to a key, an access key, a run of hexadecimal digits.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex")
ADDED = "crf"

BITS = 18
WINDOW = 48
SAMPLE_ROWS = 2000
_OUT, _BEGIN, _IN = 0, 1, 2
TAGS = 3


def _patterns():
    """Finders of (start, end, start of the secret itself), with what a text must hold to be searched."""
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    # A run of at least so many signs is found at the same places as any run that is then measured.
    access, hexadecimal = re.compile(ACCESS[:-1] + "{16,}"), re.compile(HEX[:-1] + "{24,}")
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")

    def find(text: str) -> list[tuple[int, int, int, int]]:
        """(start, kind, end, start of the value), by start and kind."""
        found = []
        low = text.lower()
        if any(w in low for w in words):
            found += [(m.start(), 0, m.end(), m.start(2)) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end(), m.start()) for m in access.finditer(text)]
        found += [(m.start(), 2, m.end(), m.start()) for m in hexadecimal.finditer(text)]
        return sorted(found)

    return find


class Tokens(NamedTuple):
    """Tokens of a chunk: row, first byte, byte after the last, and hashed features, one column for each."""

    row: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    features: np.ndarray


#: Features that look at neighbouring words, and those that see a token's exact shape or letters.
_NEIGHBOURS = (3, 4, 5, 6, 7)
_EXACT = (1, 2, 8, 9, 10, 11, 12)
FEATURES = 16


class Tokenizer:
    def __init__(self):
        kind = np.full(256, 5, np.uint8)  # 0 white space, 1 digit, 2 lower, 3 upper, 4 beyond ASCII and _, 5 others
        kind[[0x20, *range(0x09, 0x0E)]] = 0
        for a, b, k in ((0x30, 0x39, 1), (0x61, 0x7A, 2), (0x41, 0x5A, 3), (0x80, 0xFF, 4), (0x5F, 0x5F, 4)):
            kind[a : b + 1] = k
        self.kind = kind
        self.hexadecimal = np.zeros(256, bool)
        self.hexadecimal[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
        self.values, self.powers, self.salts = seeded(256, 31), seeded(8, 37), seeded(FEATURES, 43)
        self.values[0x41:0x5B] = self.values[0x61:0x7B]
        self.coarse = np.array([6, 10, 16])
        self.edges = np.array([2, 3, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64])

    def __call__(self, chunk: Chunk) -> Tokens:
        data, offsets = chunk.data, chunk.offsets
        kind = self.kind[data]
        inside = (kind >= 1) & (kind <= 4)
        before = np.append(False, inside[:-1])
        cuts = offsets[1:-1]
        before[cuts[cuts < len(data)]] = False
        begins = (inside & ~before) | (kind == 5)
        start = np.flatnonzero(begins)
        if not len(start):
            return Tokens(*[np.zeros(0, np.int64)] * 3, np.zeros((0, FEATURES), np.int32))
        row = np.searchsorted(offsets, start, "right") - 1
        # Up to the next token, less the white space between.
        full = np.append(start[1:], len(data))
        stop = full - np.add.reduceat((kind == 0).astype(np.int32), start)
        return Tokens(row, start, stop, self._features(chunk, kind, row, start, stop))

    def _features(self, chunk: Chunk, kind: np.ndarray, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        data, count = chunk.data, len(start)
        count_of = lambda flags: np.add.reduceat(flags.astype(np.int32), start)
        size = stop - start
        digits, lower, upper, other = (count_of(kind == k) for k in (1, 2, 3, 4))
        sign = kind[start] == 5
        change = np.append(False, (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (kind[1:] < 5) & (kind[:-1] < 5))
        change[start] = False
        changes = np.minimum(np.frexp(count_of(change).astype(float))[1], 5)
        hexadecimal = count_of(self.hexadecimal[data]) == size
        length = np.searchsorted(self.edges, size, "right")
        classes = (digits > 0) + 2 * (lower > 0) + 4 * (upper > 0) + 8 * (other > 0) + 16 * sign
        shape = ((length * 32 + classes) * 8 + changes) * 2 + hexadecimal
        # The word: its first eight letters, any case.
        word = np.zeros(count, np.uint64)
        for i in range(8):
            has = size > i
            word[has] += self.values[data[start[has] + i]] * self.powers[i]
        first = np.zeros(count, np.uint64)
        for i in range(4):
            has = size > i
            first[has] += self.values[data[start[has] + i]] * self.powers[i]
        mixed = (digits > 0) & ((lower > 0) | (upper > 0))
        # Coarse: digits, letters or both, and whether short or long.
        coarse = (2 * mixed + (digits > 0)) * 4 + np.searchsorted(self.coarse, size, "right")

        def beside(values: np.ndarray, step: int) -> np.ndarray:
            """What the token ``step`` places on has, 0 beyond the text."""
            out = np.zeros(count, values.dtype)
            if abs(step) < count:
                here, there = (slice(-step, None), slice(None, step)) if step < 0 else (slice(None, -step), slice(step, None))
                same = row[here] == row[there]
                out[here] = np.where(same, values[there], values.dtype.type(0))
            return out

        glued = np.append(False, (start[1:] == stop[:-1]) & (row[1:] == row[:-1]))
        # The text as a whole: shares of tokens with digits among letters, and of signs.
        rows = chunk.rows
        tokens = np.maximum(np.bincount(row, minlength=rows), 1)
        share = lambda flags: np.minimum(np.frexp(256 * np.bincount(row[flags], minlength=rows) / tokens)[1], 9)[row] + 1
        files_mixed, files_signs = share(mixed), share(sign)
        plain = np.where(digits > 0, np.uint64(1), word)
        n = lambda x: x.astype(np.uint64)
        columns = [
            n(np.ones(count)),
            n(shape),
            plain,
            beside(plain, -1), beside(plain, -2), beside(plain, -3), beside(plain, 1), beside(plain, 2),
            n(beside(n(shape) + np.uint64(1), -1)),
            n(((classes * 2 + glued) * 2 + np.append(glued[1:], False)) * 16 + length),
            np.where(digits > 0, first, np.uint64(0)),
            n((files_mixed * 16 + length) * 32 + classes),
            n((files_signs * 16 + length) * 32 + classes),
            n(coarse),
            n(coarse * 8 + changes),
            n(coarse * 8 + beside(np.minimum(kind[start], 6) + 1, -1)),
        ]
        place = np.uint64(64 - BITS)
        return np.column_stack([(mix(c ^ s) >> place).astype(np.int32) for c, s in zip(columns, self.salts, strict=True)])


class Field(NamedTuple):
    """Weights: by feature and tag, by pair of tags, and by the first tag."""

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        """(tokens, tags)"""
        total = np.zeros((len(features), TAGS), np.float32)
        for k in range(features.shape[1]):
            total += self.weights[features[:, k]]
        return total

    def lead(self) -> float:
        """What the transitions about a token can favour another tag over outside by, at most."""
        p, f = self.pairs, self.first
        most = [
            max(into[y] + p[y, c] - into[_OUT] - p[_OUT, c], into[y] - into[_OUT])
            for into in (*p, f) for y in (_BEGIN, _IN) for c in range(TAGS)
        ]
        return float(max(most))


def viterbi(field: Field, scores: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The best tags of texts; tokens of a text lie together and are told apart by ``row``."""
    tags = np.zeros(len(scores), np.int8)
    if not len(scores):
        return tags
    # Sums of 32-bit scores are compared in 64 bits; the little beyond ``lead`` is for rounding.
    open_ = scores[:, _OUT] - scores[:, 1:].max(axis=1) <= field.lead() + 1e-3
    new = np.append(True, row[1:] != row[:-1])
    starts = open_ & (new | np.append(True, ~open_[:-1]))
    begin = np.flatnonzero(starts)
    if not len(begin):
        return tags
    last = open_ & np.append(new[1:] | ~open_[1:], True)
    end = np.flatnonzero(last)
    # Longest runs first, so that those that go on are the first ones of each step.
    order = np.argsort(begin - end, kind="stable")
    begin, end = begin[order], end[order]
    size = end - begin + 1
    best = np.where(new[begin][:, None], field.first, field.pairs[_OUT]) + scores[begin].astype(np.float64)
    back = np.zeros((len(scores), TAGS), np.int8)
    for t in range(1, int(size[0])):
        live = int(np.searchsorted(-size, -t, "left"))
        ways = best[:live, :, None] + field.pairs
        at = begin[:live] + t
        back[at] = ways.argmax(axis=1)
        best[:live] = ways.max(axis=1) + scores[at]
    # A run that ends before its text does is followed by a token that is outside.
    ended = np.append(new[1:], True)[end]
    tag = np.where(ended[:, None], best, best + field.pairs[:, _OUT]).argmax(axis=1)
    at = end.copy()
    live = np.arange(len(begin))
    while len(live):
        tags[at[live]] = tag[live]
        tag[live] = back[at[live], tag[live]]
        at[live] -= 1
        live = live[at[live] >= begin[live]]
    return tags


def likelihood(field: Field, features: np.ndarray, tags: np.ndarray, length: np.ndarray) -> tuple[float, Field]:
    """Log-likelihood of tagged windows and its gradient, by the forward-backward algorithm.

    ``features`` is (windows, tokens, features), ``tags`` (windows, tokens); only the first ``length`` tokens count.
    """
    n, most, k = features.shape
    score = field.scores(features.reshape(-1, k)).reshape(n, most, TAGS).astype(np.float64)
    within = np.arange(most) < length[:, None]

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    ahead = np.zeros((n, most, TAGS))
    ahead[:, 0] = field.first + score[:, 0]
    for t in range(1, most):
        step = total(ahead[:, t - 1, :, None] + field.pairs, 1) + score[:, t]
        ahead[:, t] = np.where(within[:, t, None], step, ahead[:, t - 1])
    back = np.zeros((n, most, TAGS))
    for t in range(most - 2, -1, -1):
        step = total(field.pairs + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(within[:, t + 1, None], step, 0)
    norm = total(ahead[:, -1], 1)
    share = np.exp(np.minimum(ahead + back - norm[:, None, None], 0)) * within[:, :, None]
    told = np.eye(TAGS)[tags] * within[:, :, None]
    difference = (told - share).reshape(-1, TAGS)
    weights = np.zeros(field.weights.shape)
    for c in range(TAGS):
        each = np.repeat(difference[:, c], k)
        weights[:, c] = np.bincount(features.ravel(), each, len(field.weights))
    both = within[:, 1:, None, None] * np.exp(
        np.minimum(ahead[:, :-1, :, None] + field.pairs + (score + back)[:, 1:, None, :] - norm[:, None, None, None], 0)
    )
    pairs = np.einsum("nti,ntj->ij", told[:, :-1], told[:, 1:]) - both.sum(axis=(0, 1))
    rows = np.arange(n)
    value = (score * told).sum() + field.first[tags[:, 0]].sum() - norm.sum()
    value += (field.pairs[tags[:, :-1], tags[:, 1:]] * within[:, 1:]).sum()
    first = (told[:, 0] - share[:, 0])[rows].sum(axis=0)
    return float(value), Field(weights, pairs, first)


def fit(features: np.ndarray, tags: np.ndarray, length: np.ndarray, steps: int = 60, rate: float = 0.15, shrink: float = 1e-3) -> Field:
    """The field of highest likelihood less a penalty on squares, by Adam over all windows."""
    parts = [np.zeros((1 << BITS, TAGS)), np.zeros((TAGS, TAGS)), np.zeros(TAGS)]
    moved, squared = ([np.zeros_like(p) for p in parts] for _ in range(2))
    for step in range(1, steps + 1):
        _, slope = likelihood(Field(*parts), features, tags, length)
        for p, m, s, g in zip(parts, moved, squared, slope, strict=True):
            g = g / len(features) - shrink * p
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Field(parts[0].astype(np.float32), parts[1], parts[2])


def _signs(chunk: Chunk) -> np.ndarray:
    """Code points before each byte of a chunk, from the beginning of the chunk."""
    return np.append(0, np.cumsum((chunk.data & 0xC0) != 0x80))


def _values(chunk: Chunk, texts: list, find, points: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first byte, byte after the last) of what the patterns find as secrets in a chunk."""
    spans = []
    for r, text in enumerate(texts):
        base = points[chunk.offsets[r]]
        spans += [(r, base + value, base + end) for _, _, end, value in find(text)]
    row, first, last = np.array(spans, np.int64).reshape(-1, 3).T
    # The byte at which a code point begins.
    byte = np.flatnonzero(np.diff(points))
    return row, byte[first], byte[last - 1] + 1


def _tagged(tokens: Tokens, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tags of the tokens by the spans of secrets that overlap them."""
    tags = np.zeros(len(tokens.start), np.int64)
    for a, b in zip(first, last, strict=True):
        i, j = np.searchsorted(tokens.stop, a, "right"), np.searchsorted(tokens.start, b, "left")
        if i < j and not tags[i]:
            tags[i] = _BEGIN
        tags[i:j] = np.where(tags[i:j] == _OUT, _IN, tags[i:j])
    return tags


def marked(docs: DataFrame) -> DataFrame:
    """(lot, secret): a hash of each text, and whether the patterns find a secret in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _patterns()
        for batch in batches:
            secret = [bool(find(text)) for text in batch[1].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(secret, pa.bool_())], names=["lot", "secret"])

    return docs.mapInArrow(run, "lot long, secret boolean")


def windows(docs: DataFrame) -> DataFrame:
    """(length, tags, features) of one window of each text (lot, text) that has tokens.

    Its middle is a token of a secret, or one with digits if there is none, or else any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, tokenizer = _patterns(), Tokenizer()
        digit = np.zeros(256, np.int64)
        digit[0x30:0x3A] = 1
        for batch in batches:
            column = batch[1].cast(pa.large_string())
            lots = batch[0].to_numpy(zero_copy_only=False).view(np.uint64)
            for chunk in chunks(column):
                texts = column.slice(chunk.first, chunk.rows).to_pylist()
                tokens = tokenizer(chunk)
                _, first, last = _values(chunk, texts, find, _signs(chunk))
                tags = _tagged(tokens, first, last)
                digits = np.append(0, np.cumsum(digit[chunk.data]))
                held = digits[tokens.stop] > digits[tokens.start]
                ends = np.searchsorted(tokens.row, np.arange(chunk.rows + 1))
                out: tuple[list, ...] = ([], [], [], [])
                for r in range(chunk.rows):
                    a, b, lot = int(ends[r]), int(ends[r + 1]), int(lots[chunk.first + r])
                    if a == b:
                        continue
                    chosen = np.flatnonzero(tags[a:b])
                    chosen = chosen if len(chosen) else np.flatnonzero(held[a:b])
                    middle = int(chosen[lot % len(chosen)]) if len(chosen) else lot % (b - a)
                    i = max(a, a + middle - WINDOW // 2)
                    j = min(b, i + WINDOW)
                    out[0].append(j - i)
                    out[1].append(lot % 4)
                    out[2].append(tags[i:j].astype(np.int8).tobytes())
                    out[3].append(tokens.features[i:j].astype("<i4").tobytes())
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["length", "hidden", "tags", "features"]
                )

    return docs.mapInArrow(run, "length int, hidden int, tags binary, features binary")


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field | None:
    """A field from up to ``sample_rows`` texts with secrets and as many without; None if there are no secrets."""
    texts = pick(docs, "text").where("text is not null").select(F.xxhash64("text").alias("lot"), "text")
    marks = settle(marked(texts), "texts-with-secrets")
    lots = [marks.where(F.col("secret") == x).select("lot").distinct().orderBy("lot").limit(sample_rows) for x in (True, False)]
    chosen = settle(lots[0].unionByName(lots[1]), "sample-of-texts")
    # Equal texts give equal windows; one of them is enough.
    table = settle(windows(texts.join(F.broadcast(chosen), "lot").dropDuplicates(["lot"])), "windows").toArrow()
    table = table.sort_by([("features", "ascending")])
    length = table["length"].to_numpy().astype(np.int64)
    features = np.zeros((len(table), WINDOW, FEATURES), np.int64)
    tags = np.zeros((len(table), WINDOW), np.int64)
    for i, (t, f) in enumerate(zip(table["tags"].to_pylist(), table["features"].to_pylist(), strict=True)):
        tags[i, : length[i]] = np.frombuffer(t, np.int8)
        features[i, : length[i]] = np.frombuffer(f, "<i4").reshape(-1, FEATURES)
    if not tags.any():
        return None
    draw = table["hidden"].to_numpy()
    for group, bit in ((_NEIGHBOURS, 1), (_EXACT, 2)):
        features[np.ix_(draw & bit > 0, np.arange(WINDOW), group)] = 0
    return fit(features, tags, length)


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, spans): each span a kind, its first code point and the one after its last, by start, kind in the
    order of ``KINDS``, and then what the field adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, tokenizer = _patterns(), Tokenizer()
        names = [*KINDS, ADDED]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            column = pc.fill_null(batch[1].cast(pa.large_string()), "")
            for chunk in chunks(column):
                texts = column.slice(chunk.first, chunk.rows).to_pylist()
                spans = [[(s, k, e) for s, k, e, _ in find(text)] for text in texts]
                if field is not None:
                    points = _signs(chunk)
                    tokens = tokenizer(chunk)
                    tags = viterbi(field, field.scores(tokens.features), tokens.row)
                    for i, j in _runs(tags, tokens.row):
                        r = tokens.row[i]
                        base = points[chunk.offsets[r]]
                        a, b = int(points[tokens.start[i]] - base), int(points[tokens.stop[j]] - base)
                        if not any(s < b and a < e for s, _, e in spans[r]):
                            spans[r].append((a, len(KINDS), b))
                cells = [[{"kind": names[k], "start": s, "end": e} for s, k, e in sorted(x)] for x in spans]
                yield pa.RecordBatch.from_arrays([batch[0].slice(chunk.first, chunk.rows), pa.array(cells, kind)], names=["doc_id", "spans"])

    kinds = "doc_id long, spans array<struct<kind string, start long, end long>>"
    return pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, kinds)


def _runs(tags: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last tokens of tagged spans; inside after outside begins one."""
    held = tags != _OUT
    new = np.append(True, row[1:] != row[:-1])[: len(tags)]
    begins = held & ((tags == _BEGIN) | new | np.append(True, ~held[:-1])[: len(tags)])
    ends = held & np.append(begins[1:] | ~held[1:] | new[1:], True)[: len(tags)]
    return zip(np.flatnonzero(begins).tolist(), np.flatnonzero(ends).tolist(), strict=True)
