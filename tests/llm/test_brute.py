"""Chunk boundaries, language vectors and toxicity against plain versions, made without the modules' own steps."""

import base64
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from meterlab.llm import fingerprints, language, toxicity
from meterlab.llm.text import by_letters, chunks


def plain_chunks(raw):
    """Byte by byte: shift the gear hash, and end a chunk where the bits of its size say so."""
    gear = [int(g) for g in fingerprints._GEAR]
    ends, start, h = [], 0, 0
    for i, byte in enumerate(raw):
        h = ((h << 1) + gear[byte]) & 0xFFFFFFFF
        size = i + 1 - start
        zeros = 6 if size < 40 else 4
        if i + 1 == len(raw) or size == 192 or (size >= 12 and h >> (32 - zeros) == 0):
            ends.append(i + 1)
            start = i + 1
    return ends


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_byte_by_byte(seed):
    draw = np.random.default_rng(seed)
    words = ["alpha", "é", "of", "the", "zzzz", "\n", "naïve", "Ω"]
    for size in (0, 1, 11, 12, 13, 50, 500, 5000):
        raw = draw.integers(0, 256, size, np.uint8).tobytes() if seed % 2 else " ".join(draw.choice(words, size)).encode()
        assert fingerprints.boundaries(raw) == plain_chunks(raw)
        start, expected = 0, {}
        for end in plain_chunks(raw):
            expected[xxhash.xxh3_64_intdigest(raw[start:end])] = end - start
            start = end
        table = b"".join(k.to_bytes(8, "big") + n.to_bytes(2, "big") for k, n in sorted(expected.items()))
        assert fingerprints.encode(fingerprints.chunk_table(raw)) == base64.b64encode(table).decode()


def test_language_vectors_letter_by_letter():
    """A text's vector is the sum over its letters of bound, permuted vectors of them and their neighbours."""
    random = np.random.default_rng(language.SEED)
    vectors = random.choice(np.array([-1, 1], np.int8), (language.LETTERS, 64)).astype(int)
    table = language.letter_table()
    texts = ["Ab, cd!", "", "éa  z", "12 34", "x"]
    row, codes = language.trigrams(texts, table)
    for i, text in enumerate(texts):
        expected = np.zeros(64, int)
        for word in re.findall(r"[^\W\d_]+", text):
            spelt = [0, *[int(table[ord(c)]) for c in word], 0]
            for a, b, c in zip(spelt, spelt[1:], spelt[2:], strict=False):
                expected += np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
        found = language.trigram_vectors(codes[row == i], 64, language.SEED).sum(axis=0)
        assert (found == expected).all(), text
    assert table[ord("a")] == table[ord("A")] == 1 and table[0x1F600] == 0 and table[0x20000] > 26


def test_word_counts_and_suspicion(spark):
    draw = np.random.default_rng(1)
    plain = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(400):
        words = list(draw.choice(plain, 12))
        toxic = int(i % 4 == 0)
        if toxic and draw.random() < 0.9:
            words.append("Nasty")
        if draw.random() < 0.1:
            words.append("odd")
        rows.append((i, toxic, " ".join(words)))
    df = spark.createDataFrame(rows, "lot long, toxic int, text string")
    sets = toxicity.word_sets(df)
    counts = {r.word: (r.texts, r.toxic) for r in toxicity.word_counts(sets).collect()}
    names = {}
    split = by_letters()
    for word in [*plain, "nasty", "odd"]:
        names[word] = int(split(next(chunks(pa.array([word])))).hash.view(np.int64)[0])
    texts, held = Counter(), Counter()
    for _, toxic, text in rows:
        for word in set(text.lower().split()):
            texts[word] += 1
            held[word] += toxic
    assert all(counts[names[w]] == (texts[w], held[w]) for w in names)

    n, bad = 400, 100
    expected = set()
    for k, (c, t) in counts.items():
        odds = math.log((t + 0.5) / (bad + 1)) - math.log((c - t + 0.5) / (n - bad + 1))
        ratio = 2 * sum(x * math.log(x / c / share) for x, share in ((t, bad / n), (c - t, 1 - bad / n)) if x)
        if odds > 0 and ratio > 2 * math.log(len(counts)) + toxicity.MARGIN:
            expected.add(k)
    found = {r.word for r in toxicity.suspicious(toxicity.word_counts(sets), bad, n).collect()}
    assert found == expected and names["nasty"] in found and names["odd"] not in found


def test_fit_is_a_minimum():
    """No small change of a weight or threshold lowers the penalised loss of the cumulative-link model."""
    draw = np.random.default_rng(3)
    word = np.arange(1, 9, dtype=np.uint64)
    toxic = np.arange(300) % 3 == 0
    sets = [np.sort(draw.choice(word, draw.integers(1, 4) if t else draw.integers(0, 2), replace=False)) for t in toxic]
    odds = np.linspace(0.5, 3, 8)
    model = toxicity.fit(sets, toxic, word, odds, steps=4000)
    scale = np.minimum(odds, 4.0)
    weight = np.zeros(8)
    weight[np.searchsorted(word, model.word)] = model.weight / scale[np.searchsorted(word, model.word)]

    def loss(weight, threshold):
        total = toxicity.PENALTY * np.abs(weight).sum()
        for held, t in zip(sets, toxic, strict=True):
            linear = (weight * scale)[np.searchsorted(word, held)].sum()
            grade = min(max(len(held), 1), 3) if t else 0
            for k in range(1, toxicity.GRADES):
                p = 1 / (1 + math.exp(threshold[k - 1] - linear))
                total -= (math.sqrt(2) if t else 1) * math.log(p if grade >= k else 1 - p)
        return total

    least = loss(weight, model.threshold)
    assert (np.diff(model.threshold) >= 0).all()
    for i in range(8):
        for by in (-0.05, 0.05):
            changed = weight.copy()
            changed[i] += by
            assert loss(changed, model.threshold) >= least - 1e-3
    for k in range(3):
        for by in (-0.05, 0.05):
            changed = model.threshold.copy()
            changed[k] += by
            if (np.diff(changed) >= 0).all():
                assert loss(weight, changed) >= least - 1e-3
