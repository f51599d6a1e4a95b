"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_queries import brute_join

import corpus_pipeline
from meterlab.llm import chat, components, fingerprints, language, lines, mixing, neighbours, ngram_join, packing, quality, text, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, DOC_ID string, size string, key string"
LONG = " ".join(f"word{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, None, None), (2, "", "en", "b"), (3, " \n\t ", "en", "b"), (4, "One two", "de", None),
        (5, LONG, "en", "a"), (5, LONG, "en", "a"), (6, "é" * 50, "fr", "ü"), (None, "no id here", "en", "a"),
        (7, "same text again and again", "en", "a"), (8, "same text again and again", "de", "b"), (9, "A<|end|>b", None, "a"),
    ]
    return spark.createDataFrame([(i, t, g, s, -1, "x", "y", "z") for i, t, g, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (4, None, None), (5, 1, 0), (5, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )


def test_packing(spark, odd):
    found = packing.pack_documents(odd).toPandas()
    assert found.length[found.doc_id == 1].tolist() == [1] and found.length[found.doc_id == 2].tolist() == [1]
    assert len(found[found.piece == 0]) == odd.count()
    assert found.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_packing_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>  b\n", "<|endoftext|", "plain <|end|> text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = packing.pieces_of(df).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert found.length[i] == len(ids) and found.ids_crc32[i] == zlib.crc32(np.array(ids, "<u4").tobytes()), t


def test_packing_tree(spark):
    rows = [(i, 0, 0, 1 + i * 7919 % 2048, 0) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(40)
    found = packing.pack(pieces, fan_in=3).toPandas().sort_values(["sequence_id", "offset"])
    assert len(found) == 3000
    assert (found.groupby("sequence_id").length.cumsum() - found.length == found.offset).all()
    assert found.groupby("sequence_id").length.sum().max() <= 2048
    assert found.sequence_id.nunique() <= 1.03 * packing.best_fit(found.length.to_numpy(), 2048)[2]
    half = pieces.withColumn("length", F.lit(1300).cast("long"))
    assert packing.pack(half, fan_in=3, group_rows=100).select("sequence_id").distinct().count() == 3000


def test_packing_mixes_sources(spark):
    # Two to a bin leave room that only the other source's pieces fill; both keep more rows than a group takes.
    rows = [(i, 0, 0, 900 if i < 2000 else 220, 0) for i in range(4000)]
    pieces = spark.createDataFrame(spark.sparkContext.parallelize(rows, 40), "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(pieces, fan_in=2, group_rows=100).toPandas().sort_values(["sequence_id", "offset"])
    assert sorted(found.doc_id) == list(range(4000))
    assert (found.groupby("sequence_id").length.cumsum() - found.length == found.offset).all()
    assert found.groupby("sequence_id").length.sum().max() <= 2048
    assert found.sequence_id.nunique() <= 1.05 * packing.best_fit(found.length.to_numpy(), 2048)[2]


def test_best_fit_by_hand():
    where, offset, bins = packing.best_fit(np.array([5, 7, 3, 2, 4]), 10)
    assert bins == 3 and where[1] == where[2] and offset[2] == 7 and where[0] == where[4]


def test_lines(spark):
    passage = "Here is a passage of more than eight words that is quoted. It has a second sentence of many words too."
    rows = [
        (1, f"Start.\n{passage}\nEnd of one."), (2, f"Other words come first here. {passage}\nLast line of this one."),
        (3, None), (4, ""), (5, passage), (6, "All rights reserved.\nNothing else."), (7, "All rights reserved.\nUnlike."),
        (8, LONG), (9, LONG), (None, passage), (10, f"x {passage.upper()}"),
    ]
    df = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, TAG string")
    found = {r.doc_id: r for r in lines.dedup(df).collect()}
    assert found[1].text == rows[0][1] and found[8].text == LONG and found[None].text == passage
    assert found[2].text == "Other words come first here.\nLast line of this one."
    assert found[3].text is None and found[4].text == "" and found[5].text == "" and found[9].text == ""
    assert found[7].text == rows[6][1] and found[5].lines_removed == 2 and found[5].TAG == "kept"
    assert lines.dedup(df.limit(0)).count() == 0


def test_lines_inside_passages(spark):
    # Sentences of six words, some of which earlier documents or other places of the later one have too.
    said = [" ".join(f"{x}{i}" for i in range(5)) + f" {x}end." for x in "abcdefghij"]
    passage = " ".join(said)
    own = [" ".join(f"own{x}{i}" for i in range(9)) + "." for x in range(4)]
    rows = [(1, f"{own[0]} {said[2]} {own[1]}"), (2, f"{said[6]} {own[2]}"), (5, passage), (9, f"{own[3]} {said[4]}\n{own[0][::-1]}\n{passage}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x.doc_id: x.text for x in lines.dedup(df).collect()}
    assert [found[i] for i in (1, 2, 5)] == [t for _, t in rows[:3]]
    assert found[9] == f"{own[3]} {said[4]}\n{own[0][::-1]}"


def test_lines_that_repeat_elsewhere(spark):
    long = [" ".join(f"{x}{i}" for i in range(12)) + "." for x in "abcd"]
    rows = [(1, "\n".join(long[:3])), (2, "\n".join([long[1], long[3], *long[:3]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.text for x in lines.dedup(df).collect()}[2] == f"{long[1]}\n{long[3]}"


def test_lines_out_of_order(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(12)) for x in "abc")
    df = spark.createDataFrame([(1, f"{a}\n{b}\n{c}"), (2, f"{c}\n{a}\n{b}")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.dedup(df).collect()}[2] == c


def test_join_with_hot_groups(spark):
    random = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(3000)])
    base = random.choice(words, 150)
    texts = [" ".join(base)] * 30 + [None, "", "one", "one", "ONE two"]
    for _ in range(60):
        own = base.copy()
        own[random.integers(0, 150, random.integers(1, 5))] = random.choice(words, 1)
        texts.append(" ".join(own))
    texts += [" ".join(random.choice(words, random.integers(1, 60))) for _ in range(60)]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, Node string")
    for size, percent in ((3, 90), (5, 80), (2, 95)):
        found = ngram_join.classes(df, size, percent).toPandas()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == brute_join(texts, range(len(texts)), size, percent)


def test_join_edges(spark, odd):
    found = ngram_join.classes(odd, 3, 90).toPandas()
    assert len(found) == odd.count()
    assert found.n_shingles[found.doc_id.isin([1, 2, 3])].tolist() == [0, 0, 0]
    assert found.component_id[found.doc_id == 8].tolist() == [7]
    assert ngram_join.classes(odd.limit(0)).count() == 0
    assert ngram_join.keep_one(odd).count() == odd.count() - 1


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components.connected(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components.connected(links.limit(0)).count() == 0


def test_chat_layouts(spark):
    records = [
        '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b</s>"}], "id": 5}',
        '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b</s>"}]}',
        '{"prompt": "a", "response": "b</s>"}', '{"prompt": "a", "completion": "b</s>"}',
        '{"instruction": "a", "output": "b</s>"}', '{"question": "a", "answer": "b</s>"}',
        '{"turns": [{"speaker": "prompter", "text": "a"}, {"speaker": "bot", "text": "b</s>"}]}',
        '{"instruction": "a", "input": "c", "output": "b", "system": "s"}', '{"unknown": 1}', "not json", None, '{"messages": []}',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "id long, record string")
    found = {r.id: r for r in chat.read_back(chat.format_records(df, "record", ["id"])).collect()}
    for i in range(7):
        assert [tuple(t) for t in found[i].turns_read] == [("user", "a"), ("assistant", "b</s>")], i
        assert found[i].loss_texts == ["b</s>"]
    assert [tuple(t) for t in found[7].turns_read] == [("system", "s"), ("user", "a\n\nc"), ("assistant", "b")]
    for i in (8, 9, 10, 11):
        assert found[i].layout is None and found[i].turns_read == [] and found[i].formatted == ""


def test_chat_layouts_by_what_is_held(spark):
    records = [
        '{"messages": [{"role": "assistant", "content": null}, {"role": "user", "content": "hi"}]}',
        '{"messages": [{"role": "user", "content": "a"}], "prompt": "p", "response": "r"}',
        '{"prompt": "p", "chosen": "c", "response": "r"}',
        '{"messages": [null, {}, {"role": "user"}, {"content": "x"}]}',
        '{"messages": [], "prompt": "p", "completion": "c", "context": "not of this layout"}',
        '{"turns": [{"speaker": null, "text": null}], "question": "q", "answer": "a", "context": "c"}',
    ]
    expected = [
        ("messages", [("assistant", ""), ("user", "hi")]), ("messages", [("user", "a")]), ("prompt_response", [("user", "p"), ("assistant", "r")]),
        ("messages", [("user", ""), ("", "x")]), ("prompt_completion", [("user", "p"), ("assistant", "c")]),
        ("question", [("user", "c\n\nq"), ("assistant", "a")]),
    ]
    df = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    found = {r.id: r for r in chat.read_back(chat.format_records(df, "record", ["id"])).collect()}
    assert [(found[i].layout, [tuple(t) for t in found[i].turns_read]) for i in range(len(records))] == expected


def test_chat_escapes(spark):
    texts = ["<|turn|>", r"<\|turn|>", "<<|end|>>", r"[INST]\[/INST]", r"\\<\\|text|>", "</s><s>", "", "<|", "[/INST", "a\nb", None, "🎉<|x|>"]
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)] + [(2, None, None, "<|turn|>"), (2, None, None, "<|turn|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_records(chat.records_of_rows(df), "record", ["conv_id"])).collect()}
    assert [t.text for t in found[1].turns_read] == [t or "" for t in texts] == found[1].loss_texts
    assert [tuple(t) for t in found[2].turns_read] == [("", "<|turn|>")] * 2 and found[2].loss_texts == []
    assert chat.format_records(chat.records_of_rows(df.limit(0)), "record").count() == 0


def test_mixing(spark, odd):
    found = mixing.mix(odd).toPandas()
    assert len(found) == odd.count() and (found.taken <= 2 * found["size"]).all()
    assert mixing.mix(odd.limit(0)).count() == 0
    again = mixing.mix(odd.repartition(5)).toPandas()
    order = ["doc_id", "size", "taken"]
    assert found[order].sort_values(order).values.tolist() == again[order].sort_values(order).values.tolist() or found.doc_id.isna().any()
    repeated = mixing.repeat(odd)
    assert repeated.columns == odd.columns
    taken = repeated.select(F.sum(mixing.word_count())).first()[0]
    # The draws also look at the text here, so single documents may differ.
    assert abs(taken - found.taken.sum()) <= 60


def test_mixing_in_groups(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", 1 + i * 31 % 50) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.copies(df, group_rows=100, fan_in=3).toPandas()
    assert len(found) == 5000
    sums = found.assign(taken=found.copies * found["size"]).groupby("source").agg({"taken": "sum", "target": "first"})
    assert (abs(sums.taken - sums.target) <= 50).all()


def test_fingerprints(spark, odd):
    found = fingerprints.with_next(odd, block_bytes=1000).toPandas()
    assert len(found) == odd.count()
    empty = found[found.doc_id == 1]
    assert empty.fingerprint.tolist() == [""] and empty.near_edited.tolist() == [1.0]
    assert fingerprints.with_next(odd.limit(0)).count() == 0
    single = fingerprints.with_next(text.pick(odd, "doc_id", "text").where("doc_id = 7")).first()
    assert single.near_next == 1.0
    marks = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd).collect()}
    assert marks[7] == marks[8] != marks[9]


def test_chunks_fall_into_step():
    random = np.random.default_rng(3)
    body = random.integers(97, 123, 20_000).astype(np.uint8).tobytes()
    one, two = (fingerprints.chunk_table(x) for x in (body, b"something new" + body))
    assert fingerprints.likeness(one, two) > 0.95
    ends = fingerprints.boundaries(body)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(body) and sizes[:-1].min() >= fingerprints.LEAST and sizes.max() <= fingerprints.MOST


def test_quality(spark, odd, labels):
    found = quality.score(odd, labels).toPandas()
    assert len(found) == odd.count() and found.score.between(0, 1).all()
    assert quality.score(odd.limit(0), labels).count() == 0
    none = quality.score(odd, labels.limit(0)).toPandas()
    assert (none.score == 0.5).all()
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns


@pytest.mark.parametrize("prior", [0.1, 0.5, 0.9])
def test_prior_from_positives_and_unlabelled(prior):
    """Scores of two overlapping kinds, of which the unlabelled hold a known share."""
    draw = np.random.default_rng(int(10 * prior))
    good, bad = draw.normal(2, 1, 40_000), draw.normal(-2, 1, 40_000)
    mixed = np.concatenate([good[: int(20_000 * prior)], bad[: int(20_000 * (1 - prior))]])
    assert quality.estimate_prior(good[20_000:], mixed) == pytest.approx(prior, abs=0.04)


def test_quality_reads_no_bad_labels(spark):
    draw = np.random.default_rng(2)
    text = lambda good: " ".join(draw.choice(["house", "tree", "and", "river."] if good else ["$$$", "BUY!!!", "|", "###"], 40))
    rows = [(i, text(i % 4 != 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 3)], "doc_id long, quality int")
    one = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality.score(docs, labels.where("quality = 1")).collect()}
    assert one == two
    assert np.mean([(one[i] >= 0.5) == (i % 4 != 0) for i, _ in rows]) > 0.95


def test_risk_falls_to_where_it_should():
    """The fit's risk is that of the formula, computed anew, and about the least that any shift of its scores gives."""
    draw = np.random.default_rng(6)
    p, u = draw.normal(1, 1, (600, 3)), np.concatenate([draw.normal(1, 1, (300, 3)), draw.normal(-1, 1, (300, 3))])
    model = quality.fit(p, u, 0.5, steps=600)

    def risk(shift):
        f, g = (quality._forward(model.layers, (x - model.mean) / model.scale)[1] + shift for x in (p, u))
        loss = lambda v: np.mean([np.log1p(np.exp(-x)) for x in v])
        return 0.5 * loss(f) + max(0.0, loss(-g) - 0.5 * loss(-f))

    assert risk(0) <= min(risk(s) for s in np.linspace(-3, 3, 25)) + 0.03


def test_toxicity(spark, odd, labels):
    found = toxicity.score(odd, toxicity.learn(odd, labels)).toPandas()
    assert len(found) == odd.count() and found.severity.between(0, 3).all()
    assert toxicity.score(odd.limit(0), toxicity.learn(odd.limit(0), labels)).count() == 0
    bad = [(i, f"w{i} some words here {'jerkish' if i % 4 == 0 else 'nice'} {i % 13}", int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in bad] + [(1000, "you JERKISH thing")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in bad], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.learn(docs, labels)).toPandas().set_index("doc_id")
    assert (found.toxic[:400] == [x for *_, x in bad]).all() and found.toxic[1000] == 1


def test_language(spark, odd):
    found = language.predict(odd).toPandas()
    assert len(found) == odd.count()
    assert found.lang_pred[found.doc_id.isin([1, 2, 3])].tolist() == ["und"] * 3
    assert language.predict(odd.limit(0)).count() == 0
    untaught = language.predict(odd.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert (untaught.lang_pred == "und").all() and (untaught.score == 0).all()


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_beside_a_common_passage(spark, size, percent):
    """A third of the texts share a passage, near copies form chains, and sizes differ by far: no link is lost."""
    draw = np.random.default_rng(size)
    words = lambda n: [f"w{draw.integers(4000)}" for _ in range(n)]
    passage, texts = words(60), []
    for i in range(150):
        own = words(int(draw.integers(5, 400)))
        texts.append(own + passage if i % 3 == 0 else own)
    for i in range(0, 150, 5):
        for step in range(1, 5):
            text = list(texts[i])
            for at in draw.integers(0, len(text), max(1, step * len(text) // 120)):
                text[at] = f"changed{step}{at}"
            texts.append(text + words(step % 2))
    texts += [passage, passage[:59], passage + passage, texts[0], ["w1"], ["w1"], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    found = ngram_join.classes(df, size, percent).toPandas()
    expected = brute_join([t for _, t in rows], range(len(rows)), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 30


def test_ngram_join_of_few_words_makes_few_pairs(spark, monkeypatch):
    """Shingles that texts share by chance make no candidates; sets that are linked do, whatever their pivot is."""
    draw = np.random.default_rng(5)
    words = lambda n: [f"w{i}" for i in draw.integers(0, 25, n)]
    texts = [words(100) for _ in range(500)]
    for i in range(10):
        for at in (3, 50, 90):
            texts.append([*texts[i][:at], f"x{i}", *texts[i][at + 1 :]])
        # Linked with each other, not with the text they come from.
        far = [f"y{i}{j}" if j % 12 == 0 else w for j, w in enumerate(texts[i])]
        texts += [far, [*far[:-1], "z"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    made, settle = {}, ngram_join.settle

    def counted(df, name):
        table = settle(df, name)
        made[name] = made.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(ngram_join, "settle", counted)
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 90).toPandas()
    expected = brute_join([t for _, t in rows], range(len(rows)), 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == expected
    assert made["star-pairs"] < 100


def test_language_of_signs_and_rare_letters(spark):
    rows = [(1, "the house is here and there", "en"), (2, "das haus ist hier und dort", "de"), (3, "\U0001f600\U0001f4a9 \U0001f680", None), (4, "\U00020000\U00020001", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df).collect()}
    assert found[3] == ("und", 0.0) and found[1][0] == "en" and found[2][0] == "de"
    assert found[4][0] in ("en", "de")  # ideographs are letters


def test_lines_beside_columns_of_the_same_names(spark):
    passage = "a passage of more than eight words that stands in two documents of the table"
    rows = [(1, passage + "\nfirst text here", "x", 7), (2, "second text here\n" + passage, "y", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lines_removed string, WORDS_removed long")
    found = lines.dedup(df)
    assert found.columns == [*df.columns, "lines_removed_", "words_removed_"]
    assert [tuple(r) for r in found.orderBy("doc_id").collect()] == [(*rows[0], 0, 0), (2, "second text here", "y", 8, 1, 15)]
    stage = corpus_pipeline.line_dedup(spark, df, "")
    assert stage.columns == df.columns
    assert [tuple(r) for r in stage.orderBy("doc_id").collect()] == [rows[0], (2, "second text here", "y", 8)]


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 3.0]), (4, [-1.0, 0.5]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in neighbours.nearest(df, F.lit(True), k=3).collect()}
    assert [found[0, i] for i in (1, 2, 3)] == [(1, 1.0), (2, 1.0), (3, 0.0)]
    assert [found[2, i] for i in (1, 2, 3)] == [(0, 1.0), (1, 1.0), (3, 0.0)]
    assert {q for q, _ in found} == {0, 1, 2, 3, 4}
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_of_repeated_ids(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (15, [1.0, 0.5]), (16, [0.5, 1.0]), (16, [0.5, 1.0]), (17, [2.0, 2.0]), (20, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") == 20, k=3).collect()]
    expected = []
    for own, (i, v) in enumerate(rows):
        if i == 20:
            near = sorted((-(v[0] * w[0] + v[1] * w[1]), j) for other, (j, w) in enumerate(rows) if other != own)[:3]
            expected += [(20, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    assert sorted(found) == sorted(expected)


def test_neighbours_over_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_NODES", 150)
    monkeypatch.setattr(neighbours, "DEAL_NODES", 150)
    random = np.random.default_rng(5)
    vectors = np.concatenate([random.normal(size=(1200, 8)), np.tile(random.normal(size=8), (300, 1))])
    vectors *= random.uniform(0.5, 2, size=(1500, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=10).toPandas()
    hits = 0
    for query, rows in found.groupby("query_id"):
        score = vectors @ vectors[query]
        score[query] = -np.inf
        hits += (rows.score >= np.sort(score)[-10] - 1e-9).sum()
    assert len(found) == 750 and hits >= 0.9 * 750


def recall(spark, vectors, k=10):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=k).toPandas()
    hits = 0
    for query, rows in found.groupby("query_id"):
        score = vectors @ vectors[query]
        score[query] = -np.inf
        hits += (rows.score >= np.sort(score)[-k] - 1e-9).sum()
    return hits / (-(-len(vectors) // 20) * k)


def test_neighbours_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_NODES", 60)
    monkeypatch.setattr(neighbours, "DEAL_NODES", 60)
    monkeypatch.setattr(neighbours, "DEALS", 2)
    vectors = np.random.default_rng(8).normal(size=(4000, 16))
    assert recall(spark, vectors) >= 0.95


def test_neighbours_beside_a_long_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_NODES", 150)
    monkeypatch.setattr(neighbours, "DEAL_NODES", 150)
    vectors = np.random.default_rng(9).normal(size=(1500, 16))
    vectors[77] *= 100
    assert recall(spark, vectors) >= 0.95
    # Lists hold the nearest, not those whose rounding is alike.
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    _, packed, owners, _, count = neighbours._nodes(df.selectExpr("vec_id", "embedding as vector"))
    name = {r.node: r.vec_id for r in owners.collect()}
    lists = {name[r.node]: {name[n] for n in r.nbr} for r in neighbours.build(packed, count).collect()}
    unit = np.sort(np.linalg.norm(vectors, axis=1))[-1 - neighbours.STARTS]
    short = vectors / np.maximum(unit, np.linalg.norm(vectors, axis=1, keepdims=True))
    whole = np.column_stack([short, np.sqrt(np.maximum(0, 1 - (short * short).sum(axis=1)))])
    near = whole @ whole.T
    np.fill_diagonal(near, -9)
    best = np.argpartition(-near, 48, axis=1)[:, :48]
    assert np.mean([len(lists[i] & {*best[i]}) / 48 for i in range(1500)]) >= 0.95


def test_walk_goes_on_to_its_end(spark):
    # A path of 60 nodes: its end is 15 rounds away at four nodes a round.
    angle = np.linspace(0, np.pi / 2, 60)
    vectors = neighbours._pack(np.column_stack([np.cos(angle), np.sin(angle)]), np.zeros(60))
    packed = spark.createDataFrame(list(enumerate(vectors)), "node long, packed binary")
    rows = [(0, i, [j for j in range(i - 4, i + 5) if 0 <= j < 60 and j != i]) for i in range(60)]
    graph = spark.createDataFrame(rows, "part int, node long, nbr array<long>")
    asking = packed.where("node = 59").selectExpr("node as query", "packed", "cast(null as long) as node")
    assert neighbours.walk(graph, packed, asking, [0]).first().nodes[0] == 59
    with pytest.raises(RuntimeError):
        neighbours.walk(graph, packed, asking, [0], rounds=2)


def test_words_of_texts():
    split = text.by_space()
    column = pa.array(["a b", None, "", " Ab\x0bcd ", "x" * 5000, "a b"])
    seen = []
    for chunk in text.chunks(column, 10):
        words = split(chunk)
        raw = chunk.data.tobytes()
        seen += [(int(r) + chunk.first, raw[a:b], int(h)) for r, a, b, h in zip(*words, strict=True)]
    assert [(r, w) for r, w, _ in seen] == [(0, b"a"), (0, b"b"), (3, b"Ab"), (3, b"cd"), (4, b"x" * 5000), (5, b"a"), (5, b"b")]
    assert seen[0][2] == seen[5][2] and len({h for *_, h in seen}) == 5


def test_pipeline_stages_keep_columns(spark, odd, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns, name
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
