"""Classifiers by held-out accuracy, exact search against brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import quality, topk, toxicity
from tests.llm.data import documents, prose

BAD = ["loweick", "loweiun", "scum", "vequta", "idiot"]


def labelled(seed: int, n: int, spoil) -> tuple[list, list]:
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text, bad = prose(rng, rng.randrange(20, 120)), rng.random() < 0.2
        rows.append((i, spoil(rng, text) if bad else text))
        labels.append((i, int(not bad), int(bad)))
    return rows, labels


def toxic(rng, text):
    words = text.split(" ")
    for _ in range(3):
        words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


def junk(rng, text):
    return " ".join(w + rng.choice(["%%%", "&&&", "###"]) for w in text.split(" "))


def held(i, folds):
    return zlib.crc32(str(i).encode()) % folds


def accuracy(rows, truth, keep):
    own = [(r.score >= 0.3) == bool(truth[r.doc_id]) for r in rows if r.doc_id is not None and keep(r.doc_id) and r.doc_id in truth]
    return np.mean(own)


ODD = [(None, "idiot"), (None, None), (9000, None), (9001, ""), (9002, "scum " * 20_000), (5, "again with another text")]


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(5, 900, toxic)
    docs = documents(spark, rows + ODD)
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None), (3, 1, None), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, table)
    scored = toxicity.score(docs, model)
    assert scored.columns == [c for c in docs.columns if c != "toxicity"] + ["toxicity"]
    got = scored.select("doc_id", F.col("toxicity").alias("score")).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert accuracy(got, {i: t for i, _, t in labels if i != 5}, lambda i: held(i, 4) == 2) > 0.95
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[9000] == by_id[9001] < 0.3
    again = toxicity.fit(docs, table)
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_toxicity_ignores_labels_of_the_held_out_fold(spark):
    rows, labels = labelled(6, 300, toxic)
    docs = documents(spark, rows)
    flipped = [(i, q, 1 - t if held(i, 4) == 2 else t) for i, q, t in labels]
    one, other = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert np.array_equal(one.weights, other.weights) and one.bias == other.bias


def test_toxicity_without_labels_or_rows(spark):
    docs, none = documents(spark, ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none) is None
    assert {r.toxicity for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), None).count() == 0


def test_negative_part_of_the_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(0)
    p = [np.unique(np.r_[rng.integers(1, 50, 5), [100, 101]]).astype(np.uint32) for _ in range(60)]
    u = [np.unique(rng.integers(1, 50, 5)).astype(np.uint32) for _ in range(100)] + p[:10]
    model = toxicity.train(p, u, prior=0.1)
    assert set(model.features.tolist()) == {100, 101}
    own = toxicity._sigmoid(model.weights.sum() + model.bias)
    assert own > 0.5 > toxicity._sigmoid(model.bias)
    mean = (100 * toxicity._sigmoid(model.bias) + 10 * own) / 110
    assert abs(mean - 0.1) < 1e-6


def test_quality_on_held_out_rows(spark):
    rows, labels = labelled(8, 900, junk)
    docs = documents(spark, rows + ODD).withColumn("quality_score", F.lit("clash"))
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    fitted = quality.fit(docs, table)
    got = quality.score(docs, fitted).select("doc_id", F.col("quality_score").alias("score")).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert accuracy(got, {i: q for i, q, _ in labels if i != 5}, lambda i: held(i, 5) == 0) > 0.95
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[9000] == by_id[9001]


def test_quality_without_both_labels(spark):
    docs, schema = documents(spark, ODD), "doc_id long, quality int, toxic int"
    model, share = quality.fit(docs, spark.createDataFrame([], schema))
    assert model is None and share == 0.5
    assert {r.quality_score for r in quality.score(docs, (model, share)).collect()} == {0.5}
    model, share = quality.fit(documents(spark, []), spark.createDataFrame([(1, 1, 0)], schema))
    assert model is None


def test_word_vectors_are_sums_over_the_corpus(spark):
    from tallymart.llm import _text

    rows = [(1, "a b c a"), (2, None), (3, "b !! c"), (4, "a b c a")]
    got = quality.word_vectors(documents(spark, rows))
    import pyarrow as pa

    random_, sums = quality._random_vectors(), np.zeros((quality.BUCKETS, quality.WIDTH))
    for _, t in rows:
        for step in _text.steps(pa.array([t])):
            _, b = quality._tokens(step)
            for i in range(len(b)):
                for j in range(max(0, i - 2), min(len(b), i + 3)):
                    if i != j:
                        sums[b[i]] += random_[b[j]]
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    assert np.allclose(got, sums / np.maximum(length, 1), atol=1e-6)


def expected_top(rows, k, condition):
    good = [(i, np.floor(64 * np.array(v, float))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    width = max((len(v) for _, v in good), default=0)
    full = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    out = []
    for q in sorted({i for i, _ in full if condition(i)}):
        own = next(v for i, v in full if i == q)
        best = sorted(((-int(own @ v), i) for i, v in full if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("scale", [1.0, 0.02])
def test_top_k_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "HEAD", 30)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "STEP", 64)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 16)) * scale * rng.exponential(size=(700, 1))  # at 0.02 nearly all scores tie
    x[100:300] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(710, None), (720, [1.0, None]), (730, [float("nan")] * 16), (740, [float("inf")] * 16), (750, []), (760, [1.0]), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(4)
    got = topk.top_k(table, "vec_id % 20 = 0", 20).collect()
    assert sorted(map(tuple, got)) == expected_top(rows, 20, lambda i: i % 20 == 0)


def test_top_k_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), "vec_id % 20 = 0").count() == 0
    got = topk.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, -1.0])], schema), "vec_id % 20 = 0").collect()
    assert list(map(tuple, got)) == [(0, 1, 1, 64 * 64 - 128 * 64)]


@pytest.mark.parametrize("power", [10, 46, 50, 53])
def test_ties_of_any_size_go_to_the_smaller_id(power):
    rng = np.random.default_rng(power)
    ids = rng.permutation(2048)
    score = np.full((3, 2048), float(2**power))
    score[1, rng.integers(0, 2048, 9)] -= 1
    score[2, :] = -np.inf
    score[2, :5] = 2.0**power
    best = topk.Best(3, 20)
    for part in (slice(0, 700), slice(700, 2048)):
        best.add(np.arange(3), score[:, part], ids[part])
    for i in range(3):
        want = sorted((-s, j) for s, j in zip(score[i], ids, strict=True) if np.isfinite(s))[:20]
        got = [(-s, j) for s, j in zip(best.score[i], best.id[i], strict=True) if np.isfinite(s)]
        assert got == want


def test_a_hot_id_gives_the_fit_one_text(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(2, None), (2, None), (3, "x")]
    table = documents(spark, rows).select("doc_id", "text", (F.col("doc_id") > 1).alias("positive"))
    got = toxicity.one_text(table, "positive")
    assert got.columns == ["positive", "text"]
    got = sorted(map(tuple, got.collect()), key=str)
    assert len(got) == 3 and {t for p, t in got if p} == {None, "x"}
    assert got == sorted(map(tuple, toxicity.one_text(table.repartition(7), "positive").collect()), key=str)


def test_training_follows_the_gradient_of_the_risk(monkeypatch):
    """One step of training against differences of the risk, written out row by row."""
    rng = np.random.default_rng(1)
    p = [np.unique(np.r_[rng.integers(1, 9, 3), [100]]).astype(np.uint32) for _ in range(40)]
    u = [np.unique(rng.integers(1, 9, 3)).astype(np.uint32) for _ in range(50)] + p[:8]
    prior, features = 0.2, toxicity._select(p, u)

    def risk(w, bias):
        z = lambda rows: np.array([sum(w[features == f].sum() for f in r) + bias for r in rows])
        plus, minus = (lambda z: np.log1p(np.exp(-z)).mean()), (lambda z: np.log1p(np.exp(z)).mean())
        rest = minus(z(u)) - prior * minus(z(p))
        return prior * plus(z(p)) + rest if rest >= 0 else -rest

    start = np.zeros(len(features)), float(np.log(prior / (1 - prior)))
    slope = np.array([(risk(start[0] + d, start[1]) - risk(start[0] - d, start[1])) / 2e-5 for d in np.eye(len(features)) * 1e-5])
    # Adam's first step is the rate against the sign of each derivative.
    model = toxicity.train(p, u, prior, rounds=1, rate=0.01, decay=0)
    assert len(features) and np.allclose(model.weights, -0.01 * slope / (np.abs(slope) + 1e-8), atol=1e-4)


def test_the_network_s_probabilities_equal_a_plain_forward_pass():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, quality.POOLED))
    y = (x[:, 0] + 0.3 * rng.normal(size=2000) > 0).astype(float)
    model = quality.train(x, y, np.zeros((quality.BUCKETS, quality.WIDTH), np.float32))
    w1, b1, w2, b2 = model[3:7]
    margins = [sum(w2 * np.tanh(np.clip((r - model.center) / model.scale, -8, 8) @ w1 + b1)) + b2 for r in x]
    assert np.allclose(model.margins(x), margins)
    assert ((np.array(margins) > 0) == (y > 0)).mean() > 0.9
    assert 0.25 <= model.temperature <= 8


def test_quality_keeps_columns_of_any_name(spark):
    docs = documents(spark, [(1, "a b"), (2, None)]).withColumn("a.b", F.lit(3))
    got = quality.score(docs, (None, 0.5))
    assert got.columns == [*docs.columns, "quality_score"]
    assert {(r["a.b"], r.quality_score) for r in got.collect()} == {(3, 0.5)}


def test_first_by_hash_is_the_same_with_and_without_the_cut(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"))
    key = F.xxhash64("doc_id", F.lit(4))
    want = [r.doc_id for r in rows.orderBy(key, "doc_id").limit(100).collect()]
    assert [r.doc_id for r in toxicity.first_by_hash(rows, 100, 4).collect()] == want
    assert toxicity.first_by_hash(rows, 9000, 4).count() == 5000
