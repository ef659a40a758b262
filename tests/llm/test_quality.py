import math
import random

import numpy as np
import pytest

from panelwise.llm import quality

from .conftest import SCHEMA


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    fill = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        ws = [rng.choice(fill) for _ in range(rng.randint(20, 60))]
        kind = rng.choice([0, 1, 2, 2, 2])
        if kind == 0:
            ws[rng.randrange(len(ws))] = rng.choice(["Vile!", "nasty,"])
        if kind == 1:
            ws = [w + "$$" for w in ws]
        rows.append((i, " ".join(ws), kind))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, 2, 3, 4) for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, int(k != 1), int(k == 0)) for i, _, k in rows if i % 2], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    got = {r["doc_id"]: r for r in quality.rated(docs, labels, ["doc_id"]).collect()}
    held = [(i, k) for i, _, k in rows if i % 2 == 0]
    assert sum(got[i]["selected"] == (k == 2) for i, k in held) >= 0.97 * len(held)
    assert all(0 <= r["tail_probability"] <= r["expected_grade"] <= 2 for r in got.values())
    again = {r["doc_id"]: r for r in quality.rated(docs, labels, ["doc_id"]).collect()}
    assert got == again


def test_score_is_sum_of_weights(spark, tables):
    rows, docs, labels = tables
    weights, cuts, wanted = model = quality.train(docs, quality.graded(labels))
    assert list(cuts) == sorted(cuts)
    f = quality.Features(quality.BITS)
    for r in quality.score(docs.limit(20), model, ["text", "doc_id"]).collect():
        raw = r["text"].encode()
        ids = {i for i in f.words(raw) if wanted[i]} | set(f.shape(raw))
        s = sum(weights[i] for i in ids)
        assert math.isclose(r["score"], s, abs_tol=1e-9)
        assert np.allclose(r["tail"], [1 / (1 + math.exp(c - s)) for c in cuts])
        assert math.isclose(r["expected_grade"], sum(r["tail"]))


def test_gradient_of_the_fit():
    # The fit lowers the negative log likelihood of a separable sample.
    x = [np.array([0]), np.array([1]), np.array([2])] * 30
    w, cuts = quality.fit(x, [0, 1, 2] * 30, bits=2, epochs=40)
    assert w[0] < cuts[0] < w[1] < cuts[1] < w[2]


def test_sample_bound(tables):
    _, docs, labels = tables
    weights, _, _ = quality.train(docs, quality.graded(labels), max_rows=50)
    assert np.abs(weights).max() > 0


def test_repeated_ids_count_once_in_the_sample(spark, tables, monkeypatch):
    rows, docs, labels = tables
    hot = docs.where("doc_id = 1").crossJoin(spark.range(3000)).drop("id")
    some = docs.unionByName(hot.withColumn("text", hot["text"])).unionByName(
        hot.selectExpr(*[c if c != "text" else "concat(text, ' ', cast(rand(3) as string)) as text" for c in docs.columns]))
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, *a: seen.append(len(y)) or fit(x, y, *a))
    quality.train(some, quality.graded(labels))
    assert seen == [labels.count()]
    seen.clear()
    quality.train(some, quality.graded(labels), max_rows=100)
    assert 50 <= seen[0] <= 160


def test_edges(spark, tables, no_docs):
    _, docs, labels = tables
    none = spark.createDataFrame([], labels.schema)
    assert {r["selected"] for r in quality.rated(docs.limit(5), none, ["doc_id"]).collect()} == {True}
    assert quality.rated(no_docs, labels, ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (1, None, 1), (None, 0, 1), (3, 1, 1)], labels.schema)
    assert sorted((r["doc_id"], r["grade"]) for r in quality.graded(odd).collect()) == [(1, 1), (3, 0)]
    odd_texts = spark.createDataFrame([(i, t, "", "", 0, 1, 2, 3, 4) for i, t in enumerate([None, "", " \n", "x" * 100_000, "a"])], SCHEMA)
    out = quality.rated(odd_texts, labels, ["doc_id", "size"]).collect()
    assert len(out) == 5 and out[0]["score"] == out[1]["score"] == out[2]["score"]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(i, f"good text {i} of words" if i % 2 else "bad bad x", 1, 2, 3) for i in range(40)],
                                 "doc_id long, text string, score int, selected int, tail int")
    weights = (np.zeros(1 << quality.BITS), np.array([0.0, 1.0]), np.zeros(1 << quality.BITS, dtype=bool))
    out = quality.score(docs, weights, ["doc_id", "score", "selected", "tail"])
    assert out.columns == ["doc_id", "given_score", "given_selected", "given_tail", "score", "expected_grade", "tail"]
    assert out.where("given_score = 1 and given_selected = 2 and given_tail = 3 and score = 0").count() == 40
