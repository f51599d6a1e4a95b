"""Registered queries of the llm package, on the small tables, against SQL or brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows, sql_types

import corpus_pipeline
from meterlab.llm import fingerprints, packing, quality
from meterlab.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def docs(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet").toPandas().sort_values("doc_id", ignore_index=True)


def result(spark, tables, name):
    return QUERIES[name](spark, tables).toPandas()


@pytest.mark.parametrize("name", sorted(SQL))
def test_twins(spark, tables, name):
    con = connect(tables)
    df = QUERIES[name](spark, tables)
    assert spark_rows(df) == sql_rows(con, SQL[name])
    assert sorted(df.dtypes) == sql_types(con, SQL[name])


def test_packing_round_trip(spark, tables, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = result(spark, tables, "op1_best_fit_packing").sort_values(["doc_id", "piece"])
    pieces = {k: g for k, g in found.groupby("doc_id")}
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = pieces[doc_id]
        assert list(own.piece) == list(range(-(-len(ids) // 2048)))
        assert (own.length.to_numpy()[1:] == 2048).all() and own.length.max() <= 2048
        at = 0
        for start, length, crc in zip(own.start, own.length, own.ids_crc32, strict=True):
            assert start == at
            at += length
            assert crc == zlib.crc32(np.array(ids[start:at], "<u4").tobytes())
        assert at == len(ids)
    bins = found.sort_values(["sequence_id", "offset"])
    before = bins.groupby("sequence_id").length.cumsum() - bins.length
    assert (before == bins.offset).all()
    assert bins.groupby("sequence_id").length.sum().max() <= 2048
    best = packing.best_fit(found.length.to_numpy(), 2048)[2]
    assert found.sequence_id.nunique() <= best * 1.02 + 1


def brute_join(texts, ids, size, percent):
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    sets = [
        frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
        for w in words
    ]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for token in s:
            holders.setdefault(token, []).append(i)
    seen = Counter()
    for held in holders.values():
        seen.update((a, b) for k, b in enumerate(held) for a in held[:k])
    for (a, b), shared in seen.items():
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, doc_id in enumerate(ids):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: (len(s), least[find(i)]) for i, (doc_id, s) in enumerate(zip(ids, sets, strict=True))}


def test_ngram_join(spark, tables, docs):
    found = result(spark, tables, "op4_ngram_jaccard_join")
    expected = brute_join(docs.text, docs.doc_id, 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == expected


def test_nearest_neighbours(spark, tables):
    table = spark.read.parquet(f"{tables}/embeddings.parquet").toPandas()
    vectors, ids = np.vstack(table.embedding).astype(float), table.vec_id.to_numpy()
    found = result(spark, tables, "op2_nearest_neighbours").sort_values(["query_id", "rank"])
    hits = total = 0
    for query, rows in found.groupby("query_id"):
        score = vectors @ vectors[np.flatnonzero(ids == query)[0]]
        best = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:20]
        of = dict(zip(ids, score, strict=True))
        assert np.allclose([of[v] for v in rows.vec_id], rows.score, atol=1e-12)
        assert list(rows["rank"]) == list(range(1, len(best) + 1))
        hits += len({*ids[best]} & {*rows.vec_id})
        total += len(best)
    assert found.query_id.nunique() == (ids % 20 == 0).sum()
    assert hits >= 0.9 * total


def test_line_dedup(spark, tables, docs):
    found = result(spark, tables, "op3_line_dedup").set_index("doc_id")
    assert sorted(found.index) == sorted(docs.doc_id)

    def windows(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 50]) for i in range(len(words) - 49)}

    before, after, lines = Counter(), Counter(), Counter()
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        before.update(windows(text))
        after.update(windows(found.text[doc_id]))
        lines.update({x.strip() for x in re.split(r"\n|(?<=[.!?])\s", (text or "").lower())})
    repeats = sum(v - 1 for v in before.values())
    assert sum(v - 1 for v in after.values()) <= 0.05 * repeats
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        own = [x.strip() for x in re.split(r"\n|(?<=[.!?])\s", (text or "").lower())]
        if all(lines[x] == 1 for x in own):
            assert found.text[doc_id] == text and found.lines_removed[doc_id] == 0


def test_mixing(spark, tables, docs):
    found = result(spark, tables, "op7_source_mixing").set_index("doc_id")
    size = docs.text.fillna("").map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert (found["size"].reindex(docs.doc_id).to_numpy() == size.to_numpy()).all()
    totals = size.groupby(docs.source.to_numpy()).sum().sort_index()
    weight = np.array([(5, 2, 1)[i % 3] for i in range(len(totals))], float)
    limit, left = 2.0 * totals.to_numpy(), 1.5 * size.sum()
    target, free = np.zeros(len(totals)), np.ones(len(totals), bool)
    while True:
        part = (left - limit[~free].sum()) * weight / weight[free].sum()
        over = free & (part > limit)
        if not over.any():
            break
        free &= ~over
    target = np.where(free, part, limit)
    aims = found.join(docs.set_index("doc_id").source).groupby("source").agg({"target": "first", "taken": "sum", "source_size": "first"})
    assert np.allclose(aims.target.sort_index(), target)
    assert (aims.source_size.sort_index() == totals).all()
    assert (abs(aims.taken - aims.target) <= size.groupby(docs.source.to_numpy()).max()).all()
    assert (found.taken <= 2 * found["size"]).all() and (found.taken % found["size"].clip(lower=1) == 0).all()
    again = result(spark, tables, "op7_source_mixing").set_index("doc_id")
    assert (again.taken.reindex(found.index) == found.taken).all()


def test_fingerprints(spark, tables, docs):
    found = result(spark, tables, "op8_document_fingerprints").set_index("doc_id")
    texts = docs.text.fillna("").tolist()
    for i, (doc_id, text) in enumerate(zip(docs.doc_id, texts, strict=True)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = found.loc[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        one, two, three = (fingerprints.chunk_table(t.encode()) for t in (text, edited, following))
        assert (row.fingerprint, row.edited_fingerprint) == (fingerprints.encode(one), fingerprints.encode(two))
        assert row.near_edited == fingerprints.likeness(one, two)
        assert row.near_next == fingerprints.likeness(one, three)
    assert found.near_edited.mean() > 0.4 and found.near_next.mean() < 0.05


def fold(ids, parts):
    return np.array([zlib.crc32(str(i).encode()) % parts for i in ids])


def test_quality(spark, tables, docs):
    found = result(spark, tables, "op9_quality_classifier").set_index("doc_id")
    labels = spark.read.parquet(f"{tables}/labels.parquet").toPandas().set_index("doc_id").quality
    assert (found.held_out == (fold(found.index, 3) == 1)).all()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.5)).all()
    held = found[found.held_out].join(labels, how="inner")
    assert (held.predicted == held.quality).mean() > 0.9


def test_language(spark, tables, docs):
    found = result(spark, tables, "op10_language_id").set_index("doc_id")
    assert (found.held_out == (fold(found.index, 4) == 2)).all()
    held = found[found.held_out].join(docs.set_index("doc_id").lang)
    assert (held.lang_pred == held.lang).mean() > 0.95


def test_toxicity(spark, tables, docs):
    found = result(spark, tables, "op6_toxicity")
    assert sorted(found.doc_id) == sorted(docs.doc_id)
    assert found.severity.between(0, 3).all()


def test_pipeline(spark, tables):
    """Each stage against what it is given."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = docs.columns
    stages = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        stages.append((name, docs.toPandas(), out.toPandas()))
        docs = out
        if name != "best-fit packing":
            assert out.columns == names
    good, kept, single, mixed, packed = (s[2] for s in stages)
    score = quality.score(spark.createDataFrame(stages[0][1]), spark.read.parquet(f"{tables}/labels.parquet")).toPandas()
    assert {*good.doc_id} == {*score.doc_id[score.score >= 0.5]}
    assert {*kept.doc_id} <= {*good.doc_id}
    groups = brute_join(kept.text, kept.doc_id, 5, 80)
    assert {*single.doc_id} == {d for d, (n, first) in groups.items() if first == d or n == 0}
    assert {*mixed.doc_id} <= {*single.doc_id} and mixed.doc_id.value_counts().max() <= 2
    assert sorted(packed[packed.piece == 0].doc_id) == sorted(mixed.doc_id)
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


