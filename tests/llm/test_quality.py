"""Quality by pairwise ranking: held-out accuracy, features alone and together, a slow forward pass, defined cases."""

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from brute import SCHEMA, no_docs, odd_docs

import __spark_entry__ as entry
from eventide.llm import quality

TABLES = "/root/testdata/sf0.01"


def made(n=500):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 120))]
        text = " ".join(words).capitalize() + "."
        good = rng.random() < 0.75
        if not good:
            text = rng.choice([text.upper(), " ".join(w + "##" for w in words), " | ".join(words), " ".join(words[:2] * 40)])
        rows.append((i, text, rng.choice(["en", None])))
        labels.append((i, int(good)))
    return rows, labels


def test_junk_is_ranked_below(spark):
    rows, labels = made()
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs.where("doc_id % 4 <> 2"), marks.where("doc_id % 4 <> 2"))
    scored = quality.score(docs, model, ["doc_id"])
    scores = {r.doc_id: r.score for r in scored.collect()}
    held = [(scores[i] >= quality.CUT) == (y == 1) for i, y in labels if i % 4 == 2]
    assert np.mean(held) > 0.95 and all(0 <= s <= 1 for s in scores.values())
    assert 0.1 < model.quantile < 0.4
    # The same rows in other partitions give the same model.
    again = quality.train(docs.where("doc_id % 4 <> 2").repartition(5), marks.where("doc_id % 4 <> 2").repartition(3))
    assert np.array_equal(model.weights, again.weights) and model.at == again.at
    # A text's score does not depend on the others of its batch.
    for _, text, _ in rows[:40]:
        raw = np.frombuffer(text.encode(), np.uint8)
        alone = model(raw, np.array([0, len(raw)]))[0][0]
        assert np.isclose(alone, scores[rows[[t for _, t, _ in rows].index(text)][0]], atol=1e-5)
    line = np.sort(list(scores.values()))
    kept = {r.doc_id for r in quality.above_quantile(scored, 0.3).where("kept").collect()}
    assert abs(len(kept) / len(rows) - 0.7) < 0.02 and min(scores[i] for i in kept) >= line[int(0.28 * len(line))]
    odd = odd_docs(spark, clashing=True)
    assert quality.score(odd, model, ["doc_id"]).where("score BETWEEN 0 AND 1").count() == odd.count()
    assert quality.above_quantile(quality.score(no_docs(spark), model, ["doc_id"]), 0.5).count() == 0


def test_without_labels(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.train(docs, none), ["doc_id"]).collect()} == {0.0}
    some = spark.createDataFrame([(4, 1), (5, None), (None, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.train(docs, some), ["doc_id"]).collect()} == {1.0}
    # Labels of both classes, but only of missing documents.
    lost = spark.createDataFrame([(77, 1), (78, 0), (79, 1)], "doc_id long, quality int")
    assert {round(r.score, 6) for r in quality.score(docs, quality.train(docs, lost), ["doc_id"]).collect()} == {0.666667}


def test_pairs_are_won_with_the_logistic_probability():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 3)).astype(np.float32)
    truth = np.array([1.5, -0.7, 0.0])
    y = (x @ truth + rng.normal(0, 0.3, 400) > 0).astype(int)
    w = quality.fit(x, y)
    assert w[0] > 0 > w[1] and abs(w[0] / w[1] + 1.5 / 0.7) < 0.6
    better, worse = x[y == 1], x[y == 0]
    loss = lambda v: np.mean([np.log1p(np.exp(-((better - b) @ v))).mean() for b in worse])
    # No small change of the weights lowers the loss over all pairs by much.
    assert all(loss(w) < loss(w + d) + 0.02 for d in rng.normal(0, 0.3, (20, 3)))


def test_cut_is_a_quantile_of_the_scores():
    z = np.array([0.0, 1.0, 2.0, 3.0, 3.0])
    assert quality.best_cut(z, np.array([0, 0, 1, 1, 1]), np.ones(5)) == (1.5, 0.4)
    # Weighted mistakes count, and equal strengths stay together.
    assert quality.best_cut(z, np.array([0, 1, 0, 1, 1]), np.array([1, 9, 1, 1, 1.0])) == (0.5, 1 / 13)
    at, _ = quality.best_cut(z, np.array([0, 0, 0, 0, 1]), np.array([1, 1, 1, 1, 9.0]))
    assert at == 2.5
    model = quality.Model(np.ones(1), at=0.1 + 0.2, slope=3.7)
    assert (model.scored(np.array([0.1 + 0.2])) >= quality.CUT).all()
    assert (model.scored(np.array([np.nextafter(0.1 + 0.2, 0)])) < quality.CUT).all()


def test_features_stay_in_their_text():
    parts = ["Ab1c é.\nab", "", "...", "ZZ zz", "\n\n", "a b a b\na b a b"]
    raw = [p.encode() for p in parts]
    offsets = np.cumsum([0, *map(len, raw)])
    together = quality.features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for k, r in enumerate(raw):
        alone = quality.features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert np.allclose(together[k], alone[0]), parts[k]
    assert not together[1].any()


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables here")
def test_query_on_held_out_rows(spark):
    rows = entry.queries()["op11_quality"](spark, TABLES).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
