"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter trigram binds
those of its letters, each permuted by its place: ``roll(a, 2) * roll(b, 1) * c``. A
text's vector bundles (adds up) the vectors of all its trigrams, with the edges of
words as a letter of their own, and a language's prototype bundles those of all its
texts. A text gets the language whose prototype has the largest cosine with it.

Bundling is linear, so it needs how often each trigram occurs only. Prototypes come
from counts over all training texts: tasks count trigrams per language, at most
``LETTERS ** 3`` of each, and sums meet in one group per language. Frequent trigrams
are damped by the square root of their count. What all prototypes have in common is
taken off both sides, so that cosines tell languages apart.

Null texts, and those without a letter, are ``und`` with score 0. Letters are what
Unicode calls so, of all its code points, lower-cased; those beyond a-z share the
numbers that a-z leave. Ties go to the first language in code point order. Without any training text
all are ``und``. Rows that share a doc_id are treated one by one. An empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterlab.llm.text import pick
from meterlab.plans.blocks import settle

WIDTH = 1024
LETTERS = 64
SEED = 17
UNKNOWN = "und"
# Code points of text that are worked on at a time.
RUN = 1 << 20
# Texts whose vectors are made at a time.
ROWS = 128


def letter_table() -> np.ndarray:
    """Number of each code point's letter: 0 is no letter; letters share 1 to LETTERS - 1."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for code in range(len(table)):
        char = chr(code)
        if char.isalpha():
            low = ord(char.lower()[0])
            # a-z have numbers of their own; others share what is left.
            table[code] = low - 96 if 97 <= low <= 122 else 27 + low * 2_654_435_761 % 4_294_967_296 % (LETTERS - 27)
    return table


def trigram_vectors(codes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Bound vectors of trigrams, numbered in base LETTERS."""
    random = np.random.default_rng(seed)
    letters = random.choice(np.array([-1, 1], np.int8), (LETTERS, width))
    a, b, c = codes // LETTERS**2, codes // LETTERS % LETTERS, codes % LETTERS
    return (np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]).astype(np.float32)


def trigrams(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, trigram) of all trigrams of texts, and of each text's number of letters."""
    joined = "\n\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = table[points]
    ends = np.cumsum([len(t) + 2 for t in texts])
    row = np.repeat(np.arange(len(texts)), np.diff(np.append(0, ends)))[: len(letters)]
    # Runs of other characters are one edge between words.
    kept = np.ones(len(letters), bool)
    kept[1:] = (letters[1:] > 0) | (letters[:-1] > 0)
    letters, row = letters[kept].astype(np.int64), row[kept]
    pad = np.concatenate([[0], letters, [0]])
    codes = pad[:-2] * LETTERS**2 + pad[1:-1] * LETTERS + pad[2:]
    inner = pad[1:-1] > 0
    return row[inner], codes[inner]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of about RUN code points and at most ROWS rows."""
    out, size, first = [], 0, 0
    for i, text in enumerate(texts):
        out.append(text.as_py() or "")
        size += len(out[-1])
        if size >= RUN or len(out) >= ROWS:
            yield first, out
            out, size, first = [], 0, i + 1
    if out:
        yield first, out


def prototypes(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages and their vectors, learnt from all rows of (lang, text)."""

    table = letter_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for batch in batches:
            langs = batch[0].to_pylist()
            for first, texts in _pieces(batch[1]):
                row, codes = trigrams(texts, table)
                for lang in {*langs[first : first + len(texts)]}:
                    own = np.array([x == lang for x in langs[first : first + len(texts)]])
                    total = totals.setdefault(lang, np.zeros(LETTERS**3, np.int64))
                    total += np.bincount(codes[own[row]], minlength=LETTERS**3)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["lang", "code", "n"]
            )

    def bundle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("code")
        share = np.sqrt(rows["n"].to_numpy() / rows["n"].sum())
        total = np.zeros(width)
        for part in np.array_split(np.arange(len(rows)), len(rows) // 4096 + 1):
            total += share[part] @ trigram_vectors(rows["code"].to_numpy()[part], width, seed)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "vector": [total.tolist()]})

    counts = docs.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    sums = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    found = sums.groupBy("lang").applyInPandas(bundle, "lang string, vector array<double>")
    rows = sorted(settle(found, "languages").collect(), key=lambda r: r["lang"])
    return [r["lang"] for r in rows], np.array([r["vector"] for r in rows]).reshape(len(rows), width)


def predict(docs: DataFrame, learn: Column | None = None, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    Prototypes are learnt from the documents with a language whose doc_id fulfils
    ``learn``. The score is the cosine, or 0 if that is negative.
    """
    training = pick(docs, "doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs, vectors = prototypes(training.where(F.lit(True) if learn is None else learn), width, seed)
    common = vectors.mean(axis=0) if len(langs) > 1 else np.zeros(width)
    centred = vectors - common
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    towards = common / max(np.linalg.norm(common), 1e-12)
    centred, towards, table = centred.astype(np.float32), towards.astype(np.float32), letter_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.full(LETTERS**3, -1, np.int64)
        space = np.zeros((0, width), np.float32)
        for batch in batches:
            best, score = [], []
            for _, texts in _pieces(batch[1]):
                row, codes = trigrams(texts, table)
                new = np.unique(codes[known[codes] < 0])
                if len(new):
                    known[new] = len(space) + np.arange(len(new))
                    space = np.concatenate([space, trigram_vectors(new, width, seed)])
                size = len(space)
                times = np.bincount(row * size + known[codes], minlength=len(texts) * size).reshape(len(texts), size)
                text = np.sqrt(times, dtype=np.float32) @ space
                letters = times.sum(axis=1)
                text -= np.outer(text @ towards, towards)
                text /= np.maximum(np.linalg.norm(text, axis=1, keepdims=True), 1e-12)
                cosine = text @ centred.T if langs else np.zeros((len(texts), 1))
                top = cosine.argmax(axis=1)
                some = (letters > 0) & bool(langs)
                best += [langs[k] if s else UNKNOWN for k, s in zip(top, some, strict=True)]
                score += np.where(some, np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
