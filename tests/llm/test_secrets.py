"""Secret scans: patterns against plain searches, the field against enumeration, and planted secrets of other kinds."""

import hashlib
import itertools
import re

import numpy as np
import pytest

from meterlab.llm import secret_scan as scan
from meterlab.llm.queries import QUERIES

KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    """Spans of the patterns, searched one by one and measured."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(KEY, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(scan.KINDS[k], a, b) for a, k, b in sorted(found)]


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_query(spark, tables):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op13_secret_scan"](spark, tables).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = plain(docs[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, *_ in base) for x in scan.KINDS)
        assert r.base_sha256 == hashlib.sha256(told(base).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("crf:")] == [s for s in told(base).split(",") if s]
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)


@pytest.mark.parametrize("text", [
    "", "password=abc", "PassWord : 'abcdef', tokenſ=abcdef toKen=abcdef", "AKIA" + "A" * 15, "xAKIA" + "Z9" * 9 + " " + "0f" * 12,
    "ü" * 30 + 'api_key" = "aa==bb.cc"' + "ab" * 20, "token token:token=secret:aaaaaa", " password= abcdefgh", "🔑 secret=🔑 secret=abc/def+g",
])
def test_patterns(text):
    assert [(scan.KINDS[k], s, e) for s, k, e, _ in scan._patterns()(text)] == plain(text)


def random_field(seed):
    draw = np.random.default_rng(seed)
    return scan.Field(draw.normal(0, 1, (1 << scan.BITS, 3)).astype(np.float32), draw.normal(0, 1.5, (3, 3)), draw.normal(0, 1, 3)), draw


def value(field, score, tags):
    steps = sum(field.pairs[a, b] for a, b in itertools.pairwise(tags))
    return field.first[tags[0]] + steps + sum(score[i, t] for i, t in enumerate(tags))


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_finds_the_best_tags(seed):
    field, draw = random_field(seed)
    sizes = draw.integers(1, 8, 12)
    row = np.repeat(np.arange(12), sizes)
    score = draw.normal(0, 3, (len(row), 3))
    score[draw.random(len(row)) < 0.5, 0] += 25  # some are outside for sure
    tags = scan.viterbi(field, score.astype(np.float32), row)
    for r in range(12):
        own = score.astype(np.float32)[row == r].astype(float)
        best = max(itertools.product(range(3), repeat=len(own)), key=lambda t: value(field, own, t))  # noqa: B023
        assert tuple(tags[row == r]) == best


def test_likelihood_and_gradient():
    field, draw = random_field(3)
    field = scan.Field(field.weights.astype(np.float64), field.pairs, field.first)
    length = np.array([4, 1, 3])
    features = draw.integers(0, 6, (3, 4, 2))
    tags = draw.integers(0, 3, (3, 4))
    found, slope = scan.likelihood(field, features, tags, length)
    expected = 0.0
    for f, t, n in zip(features, tags, length, strict=True):
        score = field.weights[f[:n]].sum(axis=1)
        norm = np.log(sum(np.exp(value(field, score, p)) for p in itertools.product(range(3), repeat=int(n))))
        expected += value(field, score, t[:n]) - norm
    assert abs(found - expected) < 1e-4
    for part, grad in zip(field, slope, strict=True):
        for at in [(0, 0), (2, 1), (1, 2)] if part.ndim == 2 else [(0,), (2,)]:
            kept, each = part[at], []
            for by in (1e-3, -1e-3):
                part[at] = kept + by
                each.append(scan.likelihood(field, features, tags, length)[0])
            part[at] = kept
            assert abs((each[0] - each[1]) / 2e-3 - grad[at]) < 1e-2


@pytest.fixture(scope="module")
def field(spark):
    return scan.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_other_kinds_are_added_and_clean_texts_left(spark, field):
    secrets = ["Zk83hQx0pLm2vv81", "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", "ghp_16C7e42F292c6912E7710c838347Ae178B4a", "9f8e7d6c5b4a39281706ab"]
    ways = ['the passphrase: "{}" of', "use Bearer {} in", "{} is the one", 'ü auth = "{}" and']
    clean = [
        "call +49 170 1234567 or mail a.b@c.de now", "on 2024-01-25 at 10:30 for 3 people", "a secret phrase of the house",
        "version v1.2.3beta4 of file2024.txt", "chapter 12, page 344: the token was lost", "",
    ]
    texts = [w.format(s) for w, s in zip(ways, secrets, strict=True)] + clean + [None]
    found = scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), field)
    spans = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in found.collect()}
    assert [spans[i] for i in range(4)] == [[("crf", s)] for s in secrets]
    assert all(not spans[i] for i in range(4, len(texts)))


def test_given_texts_are_left_alone(spark, tables, field):
    rows = scan.scan(spark.read.parquet(f"{tables}/documents.parquet"), field).collect()
    assert sum(any(s.kind == "crf" for s in r.spans) for r in rows) <= 0.01 * len(rows)


def test_edges(spark, field):
    long = "word " * 400_000 + "password=abcdefgh"
    schema = "doc_id long, text string, DOC_ID string, spans string, lot long, kind string"
    rows = [(1, None), (2, ""), (None, "token: abcdef1"), (3, long), (3, long), (4, "\n\t ")]
    df = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], schema)
    found = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in scan.scan(df, field).collect()), key=str)
    expected = [(i, plain(t or "")) for i, t in rows]
    assert found == sorted(expected, key=str)
    assert scan.scan(df.limit(0), field).count() == 0
    assert scan.learn(df.limit(0)) is None
    plain_text = spark.createDataFrame([(1, "no secret here"), (2, "")], "doc_id long, text string")
    assert scan.learn(plain_text) is None
    assert [r.spans for r in scan.scan(plain_text, None).collect()] == [[], []]
