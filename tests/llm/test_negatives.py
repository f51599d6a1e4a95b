"""Hard negatives: the scoring against plain products, and odd rows against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlab.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, LABEL string, score string"


@pytest.mark.parametrize(("dimensions", "size"), [(1, 1), (8, 255), (13, 128), (64, 146), (100, 70_000)])
def test_scores_are_inner_products(dimensions, size):
    draw = np.random.default_rng(dimensions)
    shape = negatives.Shape(dimensions, size)
    values = np.zeros((50, shape.groups * 8), np.int64)
    values[:, :dimensions] = draw.integers(-size, size + 1, (50, dimensions))
    values[0, :dimensions], values[1, :dimensions] = -size, size
    score = shape.scores(shape.pack(values), shape.tables(values[:7]))
    assert (score == values @ values[:7].T).all()


def test_too_large_for_64_bits():
    with pytest.raises(ValueError):
        negatives.Shape(64, 2**30)


def brute(rows, each=5, most=10):
    use = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, [int(np.floor(256 * x)) for x in v], label))
    out = []
    for i, v, label in use:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in use if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:each]:
            band = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(band[:most])]
    return sorted(out)


def mined(df):
    found = negatives.mine(df, F.col("id") % 100 == 0, F.col("label"))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.select(*names).collect())


def test_odd_rows_and_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 20)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 2)
    draw = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in draw.integers(0, 3, 5) / 4], int(draw.integers(0, 3))) for i in range(0, 700, 5)]
    rows += [(7, None, 1), (8, [0.5, None, 1.0, 0.0, 0.0], 1), (9, [0.5, float("nan"), 0.0, 0.0, 0.0], 1), (10_001, [float("inf")] * 5, 1)]
    rows += [(None, [0.5] * 5, 1), (11, [0.5] * 5, None), (10_000, [], 1), (10_100, [1.0, 0.25], 2), (10_200, [-0.001] * 9, 2)]
    rows += [(10_300, [1.0] * 5, 9), (20_001, [1.0] * 5, 0), (20_001, [1.0] * 5, 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == []


def test_one_label_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 32)
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in draw.random(8)], 0 if i % 3 else 1) for i in range(400)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert mined(df) == brute(rows)
