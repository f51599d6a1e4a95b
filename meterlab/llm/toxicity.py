"""Toxicity grades by cumulative-link ordinal regression over words.

A text's features are the distinct words it holds and the beginnings of its words,
since languages inflect. One weight per feature is shared
by all ordered thresholds:

    P(grade >= k) = sigmoid(sum of weights - threshold_k),   k = 1 .. GRADES - 1,

and the expected severity is the sum of these probabilities. Labels say toxic or not
only, so grades above 0 are told apart by how much of a toxic text is suspicious:
words are suspicious if toxic labelled texts hold them more often than chance explains
(a likelihood ratio above twice the logarithm of the number of words tried, plus ``MARGIN``), and
grades 1, 2 and 3 are toxic texts with at most one, two, or more different ones.

The fit maximises the likelihood with an L1 penalty by accelerated proximal
gradient steps, on at most ``sample_rows`` labelled rows, those with the smallest
hashes of their id; toxic and other rows have a half each. Only suspicious words have
weights, and the penalty makes those without a use zero, so that scoring looks up few
words. Then every whole text is scored in one scan.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased. Null texts
are empty, and an empty text has the grade that the thresholds alone give. Without a
toxic or without another label, or without a suspicious word, every severity is about 0. A doc_id with several labels is
toxic if one of them says so; rows that share a doc_id are scored one by one. An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterlab.llm.text import Chunk, Splitter, by_letters, chunks, pick
from meterlab.plans.blocks import settle

GRADES = 4
SAMPLE_ROWS = 8_000
# Beginnings of words, by bytes, are features too: insults are inflected.
BEGINNINGS = (4, 5, 6, 8)
PENALTY = 1.0
MARGIN = 8.0


class Model(NamedTuple):
    """Words (hashes, ascending), their weights, and the ascending thresholds."""

    word: np.ndarray
    weight: np.ndarray
    threshold: np.ndarray


def _features(split: Splitter, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the words of a chunk and their beginnings, with repeats."""
    words = split(chunk)
    row, value = split.prefixes(chunk, words, BEGINNINGS)
    return np.concatenate([words.row, row]), np.concatenate([words.hash, value])


def _distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, by row and value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def word_sets(docs: DataFrame) -> DataFrame:
    """(*others, words): the distinct words of ``text`` as 64-bit hashes in one binary value."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = by_letters()
        for batch in batches:
            for chunk in chunks(batch["text"]):
                first, rows = chunk.first, chunk.rows
                row, value = _distinct(*_features(split, chunk))
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=rows))) * 8
                raw = pa.py_buffer(np.ascontiguousarray(value))
                words = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends.astype(np.int32)), raw])
                yield pa.RecordBatch.from_arrays(
                    [*[batch[c].slice(first, rows) for c in others], words], names=[*others, "words"]
                )

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in others], "words binary"]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def word_counts(sets: DataFrame) -> DataFrame:
    """(word, texts, toxic): how many of the texts, and of the toxic ones, hold each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(w.as_buffer(), np.int64) for w in batch["words"]]
            value = np.concatenate([*held, np.zeros(0, np.int64)])
            toxic = np.repeat(batch["toxic"].to_numpy(zero_copy_only=False), [len(x) for x in held])
            word, at = np.unique(value, return_inverse=True)
            sums = [np.bincount(at, minlength=len(word)), np.bincount(at, toxic, minlength=len(word)).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (word, *sums)], names=["word", "texts", "toxic"])

    parts = sets.select("toxic", "words").mapInArrow(run, "word long, texts long, toxic long")
    return parts.groupBy("word").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))


def suspicious(counts: DataFrame, n_toxic: int, n: int) -> DataFrame:
    """(word, odds) of the words that toxic texts hold more often than chance explains."""
    tried, rate = counts.count(), n_toxic / n
    # How much more often a word is found in toxic texts, smoothed.
    clean = F.col("texts") - F.col("toxic")
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n - n_toxic + 1))
    # Log-likelihood ratio of a word's share of toxic texts against the overall one.
    part = lambda k, chance: F.when(k > 0, k * F.log(k / F.col("texts") / chance)).otherwise(0.0)
    ratio = 2 * (part(F.col("toxic"), rate) + part(clean, 1 - rate))
    least = 2 * np.log(max(tried, 1)) + MARGIN
    return counts.withColumn("odds", odds).where((F.col("odds") > 0) & (ratio > F.lit(float(least)))).select("word", "odds")


def _only(sets: DataFrame, word: np.ndarray) -> DataFrame:
    """(lot, toxic, words) with none but these words, which ascend."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(w.as_buffer(), np.uint64) for w in batch["words"]]
            words = pa.array([np.intersect1d(x, word, assume_unique=True).tobytes() for x in held], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["lot"], batch["toxic"], words], names=["lot", "toxic", "words"])

    return sets.select("lot", "toxic", "words").mapInArrow(run, "lot long, toxic int, words binary")


def fit(sets: list[np.ndarray], toxic: np.ndarray, word: np.ndarray, odds: np.ndarray, penalty: float = PENALTY, steps: int = 300) -> Model:
    """Grades and weights of the words, ascending, from those that each labelled text holds."""
    thresholds = np.arange(1, GRADES, dtype=float)
    n_toxic, n = int(toxic.sum()), len(toxic)
    if not len(word) or not n_toxic or n_toxic == n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), thresholds + 30)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    column = np.searchsorted(word, np.concatenate(sets))
    found = np.bincount(row, minlength=n)
    grade = np.where(toxic, np.clip(found, 1, GRADES - 1), 0).astype(int)
    # Words enter in proportion to their odds, which puts the penalty on weak ones.
    scale = np.minimum(odds, 4.0)
    levels = np.arange(1, GRADES)
    reached = (grade[:, None] >= levels).astype(float)
    balance = np.where(toxic, np.sqrt((n - n_toxic) / n_toxic), 1.0)
    weight, threshold = np.zeros(len(word)), np.array([2.0 + k for k in range(GRADES - 1)])
    ahead_w, ahead_t, pace = weight, threshold, 1.0
    rate = 1 / (0.25 * (GRADES - 1) * balance.max() * n)
    step = rate * 20
    previous = np.inf
    for _ in range(steps):
        linear = np.bincount(row, weights=(ahead_w * scale)[column], minlength=n)
        chance = _sigmoid(linear[:, None] - ahead_t)
        slope = balance[:, None] * (chance - reached)
        to_w = np.bincount(column, weights=slope.sum(axis=1)[row], minlength=len(word)) * scale
        to_t = -slope.sum(axis=0)
        loss = -(balance[:, None] * np.log(np.where(reached > 0, chance, 1 - chance) + 1e-12)).sum() + penalty * np.abs(ahead_w).sum()
        if loss > previous:  # restart the momentum with a shorter step
            ahead_w, ahead_t, pace, step = weight, threshold, 1.0, step / 2
            previous = np.inf
            continue
        previous = loss
        new_w = ahead_w - step * to_w
        new_w = np.maximum(np.abs(new_w) - step * penalty, 0) * np.sign(new_w)
        new_t = np.maximum.accumulate(ahead_t - step * to_t)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead_w = new_w + (pace - 1) / faster * (new_w - weight)
        ahead_t = new_t + (pace - 1) / faster * (new_t - threshold)
        weight, threshold, pace = new_w, new_t, faster
    some = weight != 0
    return Model(word[some], (weight * scale)[some], np.maximum.accumulate(threshold))


def severities(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(expected severity, chance of any grade above 0) of each text."""
    severity, chance = [np.zeros(0)], [np.zeros(0)]
    split = by_letters()
    # Most features are ruled out by their first 16 bits alone.
    likely = np.zeros(1 << 16, bool)
    likely[(model.word >> np.uint64(48)).astype(np.int64)] = True
    for chunk in chunks(texts):
        rows, linear = chunk.rows, np.zeros(chunk.rows)
        if len(model.word):
            row, value = _features(split, chunk)
            hit = np.flatnonzero(likely[(value >> np.uint64(48)).astype(np.int64)])
            row, value = row[hit], value[hit]
            at = np.minimum(np.searchsorted(model.word, value), len(model.word) - 1)
            hit = model.word[at] == value
            row, value = _distinct(row[hit], value[hit])
            weights = model.weight[np.searchsorted(model.word, value)]
            linear = np.bincount(row, weights=weights, minlength=rows)
        above = _sigmoid(linear[:, None] - model.threshold)
        severity.append(above.sum(axis=1))
        chance.append(above[:, 0])
    return np.concatenate(severity), np.concatenate(chance)


def learn(docs: DataFrame, labels: DataFrame, where: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled documents whose doc_id fulfils ``where``."""
    known = pick(labels, "doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(F.lit(True) if where is None else where)
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("lot", F.xxhash64("doc_id"))
    half = sample_rows // 2
    chosen = known.where("toxic = 1").orderBy("lot").limit(half).unionByName(known.where("toxic <> 1").orderBy("lot").limit(half))
    # At most ``sample_rows`` ids, so the broadcast is bounded.
    chosen = F.broadcast(settle(chosen, "labelled").withColumnsRenamed({"doc_id": "of"}))
    texts = pick(docs, "doc_id", "text").join(chosen, F.col("doc_id") == F.col("of")).select("lot", "toxic", "text")
    sets = settle(word_sets(texts).withColumn("tie", F.xxhash64("words")), "labelled-words")
    # Ids may repeat: of their texts so many with the smallest hashes are taken, a repeated one once.
    keys = settle(sets.select("lot", "tie").distinct().orderBy("lot", "tie").limit(sample_rows), "labelled-texts")
    sets = settle(sets.join(F.broadcast(keys), ["lot", "tie"]).dropDuplicates(["lot", "tie"]), "sample-of-words")
    totals = sets.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    none = np.zeros(0, np.uint64)
    if not 0 < totals["toxic"] < totals["n"]:
        return fit([], np.zeros(0, bool), none, none)
    counts = settle(word_counts(sets), "word-counts")
    # Words are chosen where they are counted; the driver gets these alone, and what texts hold of them.
    kept = suspicious(counts, totals["toxic"], totals["n"]).toArrow()
    word, odds = kept["word"].to_numpy().view(np.uint64), kept["odds"].to_numpy()
    order = np.argsort(word)
    word, odds = word[order], odds[order]
    rows = settle(_only(sets, word), "suspicious-words").orderBy("lot", "words").toArrow()
    held = [np.frombuffer(w.as_buffer(), np.uint64) for w in rows["words"].combine_chunks()]
    return fit(held, rows["toxic"].to_numpy().astype(bool), word, odds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic) of every whole text.

    ``severity`` is the expected grade, ``grade`` the nearest whole number to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            severity, chance = severities(model, batch[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch[0],
                    pa.array(severity),
                    pa.array(np.rint(severity).astype(np.int32)),
                    pa.array(chance),
                    pa.array((chance >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "severity", "grade", "p_toxic", "toxic"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, severity double, grade int, p_toxic double, toxic int")
