"""Toxicity and language on held-out rows, and the pipeline."""

import random
import re

import numpy as np
from brute import SCHEMA, no_docs, odd_docs
from pyspark.sql import functions as F

from eventide.llm import language, toxicity

BAD = ["grobword", "vileterm", "nastyname"]


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def toxic_rows(n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, "abcdefgh", rng.randint(20, 80)).split()
        bad = rng.random() < 0.3
        for _ in range(2 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), rng.choice(["en", "de", None])))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxic_words_are_learned(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs.where("doc_id % 3 <> 1"), marks.where("doc_id % 3 <> 1"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    held = [(scores[i] >= 0.7, y == 1) for i, y in labels if i % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.95
    kept = {r.doc_id for r in toxicity.clean_documents(docs, model).collect()}
    assert np.mean([(i in kept) == (y == 0) for i, y in labels]) > 0.95
    assert set(model.thresholds) <= {"en", "de"}
    # The same rows give the same model, and the language is no input of a score.
    again = toxicity.train(docs.where("doc_id % 3 <> 1").repartition(5), marks.where("doc_id % 3 <> 1"))
    assert np.array_equal(model.out, again.out) and model.scale == again.scale
    odd = odd_docs(spark, clashing=True)
    assert toxicity.score(odd, model, ["doc_id"]).where("score BETWEEN 0 AND 1").count() == odd.count()
    assert toxicity.clean_documents(odd, model).columns == odd.columns
    assert toxicity.score(no_docs(spark), model, ["doc_id"]).count() == 0


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, f"{prose(rng, 'abcd', 6)} {BAD[i % 3] if i % 14 == 0 else 'plain'}", ["en", "de"][i % 2]) for i in range(7000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, int(i % 14 == 0)) for i, *_ in rows], "doc_id long, toxic int")
    best, weights = toxicity._best_threshold, []
    monkeypatch.setattr(toxicity, "_best_threshold", lambda s, y, w: weights.append((w[y > 0].sum(), w.sum())) or best(s, y, w))
    monkeypatch.setattr(toxicity, "PART_ROWS", 2500, raising=False)  # several networks that are averaged
    model = toxicity.train(docs, marks)
    assert weights[0] == (500, 7000)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert np.mean([(scores[i] >= 0.7) == (i % 14 == 0) for i in scores]) > 0.99
    assert model.thresholds.keys() == {"en"}  # the other one has no toxic row
    again = toxicity.train(docs.repartition(7), marks)
    assert np.array_equal(model.out, again.out) and model.scale == again.scale and model.thresholds == again.thresholds


def test_toxicity_learns_from_long_texts(spark, monkeypatch):
    # Every toxic row has more than 20,000 words, which are worked on in pieces.
    monkeypatch.setattr(toxicity, "PIECE_WORDS", 1 << 12, raising=False)
    rows = [(i, "filler text " * (10_050 if i % 3 == 0 else 5) + (BAD[0] if i % 3 == 0 else "plain"), "en") for i in range(45)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, *_ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    found = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert min(found[i] for i in found if i % 3 == 0) > max(found[i] for i in found if i % 3)


def test_buckets_come_back_from_bytes():
    for ids in ([], [0], [(1 << toxicity.BITS) - 1, 5, 70_000]):
        assert toxicity._from_bytes(toxicity._to_bytes(np.array(ids, np.int32))).tolist() == ids


def test_responses_in_pieces_are_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    known = np.arange(50)
    net = toxicity._Net(known, np.zeros(50), 3)
    texts = [rng.integers(0, 60, n).astype(np.int32) for n in (0, 1, 2, 40, 0, 300, 7)]
    ids, firsts = toxicity._batch(texts)
    whole = net._strongest(net.rows[ids], firsts)
    for size in (1, 2, 5, 64):
        monkeypatch.setattr(toxicity, "PIECE_WORDS", size)
        best, places = net._strongest(net.rows[ids], firsts)
        assert np.allclose(best, whole[0], atol=1e-6)
        # Equal responses may be told apart by rounding, but they stay in their text.
        assert (places >= firsts[:, None]).all() and (places < np.append(firsts[1:], len(ids))[:, None]).all()


def test_toxicity_moves_the_buckets_once(spark, monkeypatch):
    rows = [(i, "en", f"w{i % 7} w{i % 5} " * (i % 4)) for i in range(200)] + [(None, "en", "x"), (3, None, None)]
    docs = spark.createDataFrame(rows, "i long, lang string, text string").repartition(3)
    known = spark.createDataFrame([(i, i % 2) for i in range(0, 260, 2)] + [(4, 1), (4, 1)], "i long, y int")
    plans, kept = [], toxicity.saved

    def saved(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(toxicity, "saved", saved)
    before = spark.conf.get(toxicity.ALL_KEYS)
    first = toxicity._encoded(docs, known, 3)
    once = first.collect()
    # Each part lies in one file, in order.
    files = first.select("part", F.input_file_name().alias("file")).distinct().collect()
    assert sorted(row.part for row in files) == [0, 1, 2]
    assert spark.conf.get(toxicity.ALL_KEYS) == before
    monkeypatch.setattr(toxicity, "PART_DOCS", 0)  # as if few documents had labels
    twice = toxicity._encoded(docs, known, 3).collect()
    order = lambda row: (row.part, row.fold, row.y, row.lang or "", row.ids)
    assert sorted(once, key=order) == sorted(twice, key=order) and len(once) == 102
    assert [plan.count("Exchange hashpartitioning") for plan in plans] == [2, 3]
    assert len(re.findall(r"Exchange hashpartitioning\(part#\d+, \d+\)", plans[0])) == 2


def test_toxicity_without_labels(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, none), ["doc_id"]).collect()} == {0.0}
    some = spark.createDataFrame([(4, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, some), ["doc_id"]).collect()} == {1.0}


def test_pooling_stays_in_its_text():
    rows, labels = toxic_rows(80)
    texts = [toxicity.word_ids(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0][:-3] for _, t, _ in rows]
    model = toxicity._fit(texts, np.array([float(y) for _, y in labels]))
    one = [model(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0][0] for _, t, _ in rows]
    raw = "".join(t for _, t, _ in rows).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for _, t, _ in rows)])
    assert np.allclose(model(np.frombuffer(raw, np.uint8), offsets)[0], one, atol=1e-5)


def test_languages_are_learned(spark):
    rng = random.Random(8)
    alphabets = {"en": "abcde", "de": "abcdü", "fr": "xyzcdé"}
    rows = [(i, prose(rng, alphabets[lang], rng.randint(3, 40)), lang) for i in range(240) for lang in [rng.choice(list(alphabets))]]
    docs = spark.createDataFrame([*rows, (999, "unlabelled", None)], SCHEMA)
    model = language.train(docs.where("doc_id % 4 <> 2"))
    found = {r.doc_id: r for r in language.identify(docs, model, ["doc_id"]).collect()}
    held = [found[i].lang_pred == lang for i, _, lang in rows if i % 4 == 2]
    assert np.mean(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())
    assert (model.weights == 0).mean() > 0.5  # sparse
    odd = {r.doc_id: r for r in language.identify(odd_docs(spark, clashing=True), model, ["doc_id"]).collect()}
    for i in (1, 2, 3):
        assert (odd[i].lang_pred, odd[i].score) == ("und", 0.0)
    assert language.identify(no_docs(spark), model, ["doc_id"]).count() == 0
    nothing = language.train(no_docs(spark))
    assert {r.lang_pred for r in language.identify(docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = random.Random(3)
    # 500 names, each with letters of its own from another script block.
    letters = [chr(0x4E00 + 8 * k + j) for k in range(500) for j in range(4)]
    rows = [(3 * k + i, prose(rng, "".join(letters[4 * k : 4 * k + 4]), 12), f"l{k:03d}") for k in range(500) for i in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert len(language.train(docs).names) == 500
    # Fewer rows of each where all would be too many, but each name has some.
    few = language.train(docs, max_rows=100)
    assert len(few.names) == 500
    assert len(language.train(docs.where("doc_id < 30"), max_rows=10).names) == 10


def test_counts_do_not_cross_texts():
    parts = ["Ab1c é", "", "...", "zz"]
    raw = [p.encode() for p in parts]
    offsets = np.cumsum([0, *map(len, raw)])
    together = language.gram_counts(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for k, r in enumerate(raw):
        alone = language.gram_counts(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        mine = together[0] == k
        assert np.array_equal(together[1][mine], alone[1]) and np.array_equal(together[2][mine], alone[2])


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    rows, labels = toxic_rows(200)
    passage = prose(rng, "mnopqr", 14)
    copy = prose(rng, "stuvwx", 120)
    near = copy.split()
    near[60] = "changed"
    rows += [(500, copy, "en"), (501, copy, "en"), (502, " ".join(near), "en")]
    rows += [(503, prose(rng, "ijklm", 20) + " " + passage + " end", "en"), (504, "", None), (505, None, "en")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {500, 504, 505} <= kept
    assert not kept & {501, 502, 503}
    assert np.mean([(i in kept) == (y == 0) for i, y in labels]) > 0.95
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
