"""Quality classifier learnt from trusted positives and unlabelled text.

Positive-unlabelled learning: labelled good documents are the positives, web text
of unknown quality is the unlabelled set, and bad documents are not needed as
examples. With the share ``prior`` of good documents among the unlabelled ones,
the risk of a scorer f is

    prior * E_p[loss(f)] + max(0, E_u[loss(-f)] - prior * E_p[loss(-f)]),

whose second part estimates the risk on bad documents and cannot be negative, so
it is kept from it. Where a step would make it negative, the step goes back up
along that part instead. The prior is estimated from both samples alone: a first scorer learns
from one half of each, and on the other halves the share of unlabelled texts above a score, divided by
that of positives, is at least the prior, and equal to it where only good ones score so high. The
score is taken where this quotient and its error bound are least (best bin estimation).

The scorer is a small network over shares and lengths: how much of a text is
upper case, digits, punctuation or repeated, how long words, sentences and lines
are, and so on. All of them are counted on whole texts, in one scan, with numpy;
the features of all documents are stored, so that texts are read once.

Positives and unlabelled texts are samples of at most ``sample_rows`` rows each,
those with the smallest hashes of their id. Null texts are empty and get the
score that the model gives to an empty text. Without any positive all scores are 0.5. Rows that share a doc_id are scored one by one; a doc_id with
several labels counts as good if one of them says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterlab.llm.text import by_letters, by_space, chunks, mix, pick
from meterlab.plans.blocks import settle

SAMPLE_ROWS = 20_000
SEED = 5
FEATURES = (
    "log_bytes", "log_words", "upper", "digits", "punctuation", "symbols", "bars", "marks", "stops", "lines",
    "word_bytes", "long_words", "short_words", "symbol_words", "upper_words", "repeats", "distinct", "pairs",
    "beyond_ascii", "words_per_stop", "capitals_at_start", "ends_with_stop",
)


class Model(NamedTuple):
    """Means and scales of the features, and the layers of the network."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]


def _table(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


def _measures():
    """Function from a chunk of texts to its feature rows."""
    spaces, letters = by_space(), by_letters()
    kinds = {
        "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "digits": _table("0123456789"),
        "punctuation": _table(".,;:'\"()-"),
        "symbols": _table("#$%&*+/<=>@[\\]^_`{}~"),
        "bars": _table("|"),
        "marks": _table("!?"),
        "stops": _table("."),
        "lines": _table("\n"),
        "beyond_ascii": np.arange(256) >= 0x80,
    }

    def of(chunk) -> np.ndarray:
        data, offsets, rows = chunk.data, chunk.offsets, chunk.rows
        words, plain = spaces(chunk), letters(chunk)
        size = np.diff(offsets).astype(float)

        def per_row(flags: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(flags) + 1)
            np.cumsum(flags, out=sums[1:])
            return sums[offsets[1:]] - sums[offsets[:-1]]

        def by_row(row: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(row, weights, minlength=rows).astype(float)

        counts = {k: per_row(table[data]) for k, table in kinds.items()}
        n, total = by_row(words.row), np.maximum(size, 1)
        some = np.maximum(n, 1)
        length = words.stop - words.start
        shouted = kinds["upper"][data]
        two = np.zeros(len(words.start), bool)
        wide = np.flatnonzero(length >= 2)
        two[wide] = shouted[words.start[wide]] & shouted[words.start[wide] + 1]
        last = data[words.stop - 1] if len(words.stop) else np.zeros(0, np.uint8)
        same = np.zeros(len(plain.hash), bool)
        same[1:] = (plain.hash[1:] == plain.hash[:-1]) & (plain.row[1:] == plain.row[:-1])
        named = np.unique(plain.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ plain.hash, return_index=True)[1]
        paired = mix(plain.hash[:-1] + np.uint64(3) * plain.hash[1:]) if len(plain.hash) > 1 else plain.hash[:0]
        inner = plain.row[1:] == plain.row[:-1] if len(plain.row) > 1 else np.zeros(0, bool)
        pair_rows = plain.row[:-1][inner] if len(plain.row) > 1 else plain.row[:0]
        first_pairs = np.unique(pair_rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ paired[inner], return_index=True)[1]
        plains = np.maximum(by_row(plain.row), 1)
        ends = np.zeros(rows)
        full = np.flatnonzero(size > 0)
        ends[full] = data[offsets[1:][full] - 1] == ord(".")
        columns = {
            "log_bytes": np.log1p(size),
            "log_words": np.log1p(n),
            **{k: v / total for k, v in counts.items()},
            "word_bytes": np.log1p(by_row(words.row, length) / some),
            "long_words": by_row(words.row, length > 16) / some,
            "short_words": by_row(words.row, length <= 2) / some,
            "symbol_words": by_row(words.row, (kinds["symbols"] | kinds["marks"] | kinds["bars"])[last]) / some,
            "upper_words": by_row(words.row, two) / some,
            "repeats": by_row(plain.row, same) / plains,
            "distinct": by_row(plain.row[named]) / plains,
            "pairs": by_row(pair_rows[first_pairs]) / plains,
            "words_per_stop": np.log1p(n / (1 + counts["stops"])),
            "capitals_at_start": by_row(words.row, shouted[words.start]) / some,
            "ends_with_stop": ends,
        }
        return np.column_stack([columns[k] for k in FEATURES]).astype(np.float32)

    return of


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every whole text, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _measures()
        for batch in batches:
            rows = [measure(c) for c in chunks(batch[1])]
            values = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)), np.float32)
            ends = np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.ListArray.from_arrays(ends, pa.array(values.ravel()))], names=["doc_id", "features"]
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, features array<float>")


def _forward(layers: list, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(x @ layers[0][0] + layers[0][1], 0)
    return hidden, (hidden @ layers[1][0] + layers[1][1])[:, 0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = SEED, width: int = 32, steps: int = 2000, batch: int = 512, rate: float = 0.01, decay: float = 1e-3) -> Model:
    """Minimise the non-negative risk by Adam on batches of both samples."""
    random = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled]).astype(float)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    wide = p.shape[1]
    layers = [
        (random.normal(0, 1 / np.sqrt(wide), (wide, width)), np.zeros(width)),
        (random.normal(0, 1 / np.sqrt(width), (width, 1)), np.zeros(1)),
    ]
    flat = [x for layer in layers for x in layer]
    one, two = [np.zeros_like(x) for x in flat], [np.zeros_like(x) for x in flat]
    for step in range(1, steps + 1):
        xp = p[random.integers(0, len(p), min(batch, 4 * len(p)))]
        xu = u[random.integers(0, len(u), min(batch, 4 * len(u)))]
        x = np.concatenate([xp, xu])
        hidden, f = _forward(layers, x)
        fp, fu = f[: len(xp)], f[len(xp) :]
        # Logistic loss: log(1 + exp(-f)) for good, log(1 + exp(f)) for bad.
        bad_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        good = -prior * _sigmoid(-fp) / len(fp)
        bad_p, bad_u = -prior * _sigmoid(fp) / len(fp), _sigmoid(fu) / len(fu)
        if bad_risk >= 0:
            slope = np.concatenate([good + bad_p, bad_u])
        else:
            slope = np.concatenate([-bad_p, -bad_u])
        back = (slope[:, None] * layers[1][0][:, 0]) * (hidden > 0)
        grads = [x.T @ back, back.sum(axis=0), hidden.T @ slope[:, None], slope.sum(keepdims=True)]
        pace = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
        for i, g in enumerate(grads):
            g = g + decay * flat[i] if flat[i].ndim == 2 else g
            one[i] = 0.9 * one[i] + 0.1 * g
            two[i] = 0.999 * two[i] + 0.001 * g * g
            flat[i] -= pace * (one[i] / (1 - 0.9**step)) / (np.sqrt(two[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, layers)


def score_rows(model: Model, rows: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1 of feature rows."""
    return _sigmoid(_forward(model.layers, (rows - model.mean) / model.scale)[1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, sure: float = 0.9) -> float:
    """Share of good texts among the unlabelled ones, from scores of texts that the scorer has not learnt from."""
    p, u = np.sort(positive), np.sort(unlabelled)
    at = np.unique(np.concatenate([p, u]))
    above_p = 1 - np.searchsorted(p, at, "left") / len(p)
    above_u = 1 - np.searchsorted(u, at, "left") / len(u)
    some = above_p > 0
    above_p, above_u = above_p[some], above_u[some]
    # Both shares are off by no more than this with the probability ``sure``.
    off = sum(np.sqrt(np.log(4 / (1 - sure)) / (2 * n)) for n in (len(p), len(u)))
    best = np.argmin((above_u + 1.01 * off) / above_p)
    return float(min(0.98, max(0.02, above_u[best] / above_p[best])))


def _sample(rows: DataFrame, size: int, seed: int) -> np.ndarray:
    """Feature rows of the ``size`` smallest hashes."""
    found = rows.withColumn("_lot", F.xxhash64("doc_id", F.lit(seed))).orderBy("_lot", "features").limit(size)
    values = found.select("features").toArrow()["features"].combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)


def score(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """(doc_id, score) of every document, higher where good quality is likelier.

    ``labels`` has doc_id and quality, of which only 1 (good) is read. Only rows whose doc_id
    fulfils ``learn`` take part in the fit.
    """
    table = settle(features(docs), "quality-features")
    learn = F.lit(True) if learn is None else learn
    good = pick(labels, "doc_id", "quality").where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & learn).select("doc_id")
    positive = _sample(table.join(good.distinct(), "doc_id", "left_semi"), sample_rows, seed)
    if not len(positive):
        return table.select("doc_id", F.lit(0.5).alias("score"))
    unlabelled = _sample(table.where(learn), 2 * sample_rows, seed + 1)
    prior = 0.5
    if len(positive) > 1:
        first = fit(positive[::2], unlabelled[::2], prior, seed)
        prior = estimate_prior(score_rows(first, positive[1::2]), score_rows(first, unlabelled[1::2]))
    model = fit(positive, unlabelled, prior, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch[1].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(score_rows(model, rows))], names=["doc_id", "score"])

    return table.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, in their own columns.

    Rows that share a doc_id stay if the best of them is good enough.
    """
    good = score(docs, labels).where(F.col("score") >= threshold).select(F.col("doc_id").alias("_good")).distinct()
    names = list(docs.columns)
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    kept = plain.join(good, F.col(f"_{names.index('doc_id')}").eqNullSafe(F.col("_good")), "left_semi")
    return kept.toDF(*names)
