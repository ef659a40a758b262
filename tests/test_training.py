"""Vectors with nominal and missing values, staged scores and stopping."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwise.plans import selection
from panelwise.plans.features import build_features, feature_names
from panelwise.plans.selection import cross_validate, cross_validate_prepared, cv_rounds, predict, prepare
from panelwise.plans.training import (VectorSpec, best_round, cut_model, node_table, nominal_sizes, sliced, staged_scores,
                                      vector_spec)


def margins(model, df, ids=("id",)):
    out = model.transform(df).select(*ids, vector_to_array("rawPrediction")[1].alias("m"))
    return {tuple(r[:-1]): r["m"] for r in out.collect()}


def test_odd_codes_are_one_split(spark):
    rows = [(i, float(i % 10), float(i * 7 % 13), int(i % 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, code double, noise double, y int")
    nominal = cross_validate(df, ["code", "noise"], "y", ["id"], nominal={"code": 10}, max_iter=1, max_depth=1, score="accuracy")
    assert all(r.score == 1.0 for r in nominal.scores.collect())
    assert {r.feature: r.split for r in nominal.importances.where("fold = 0").collect()} == {"code": 1, "noise": 0}
    as_number = cross_validate(df, ["code", "noise"], "y", ["id"], max_iter=1, max_depth=1, score="accuracy")
    assert all(r.score < 0.7 for r in as_number.scores.collect())


@pytest.mark.parametrize("share", [3, 200])
def test_missingness_alone_is_learnt_in_any_row_order(spark, share):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(2000):
        gone = i % share == 0
        rows.append((i, None if gone and i % 4 else float("nan") if gone else float(rng.normal()), float(rng.normal()), int(gone)))
    df = spark.createDataFrame(rows, "id long, x double, z double, y int")
    found = [cross_validate(d, ["x", "z"], "y", ["id"], max_iter=2, max_depth=1)
             for d in (df, df.orderBy(F.rand(7)).repartition(5))]
    for cv in found:
        assert cv.spec.missing == (0,) and cv.spec.slots == ["x", "z", "x"]
        assert all(r.score > 0.95 for r in cv.scores.collect())
        per = {r.feature: r.gain for r in cv.importances.where("fold = 0").collect()}
        assert per["x"] > 0 and set(per) == {"x", "z"}
    a, b = ({r.fold: r.score for r in cv.scores.collect()} for cv in found)
    assert a == pytest.approx(b)


def test_vector_values_and_metadata(spark):
    df = spark.createDataFrame([(1, 1.5, 2.0, 1), (2, None, float("nan"), 2), (3, float("inf"), 0.0, 3)], "id int, a double, c double, k int")
    spec = vector_spec(df, ["a", "c", "k"], {"c": 3, "other": 9})
    assert (spec.missing, spec.nominal, spec.slots, spec.arity) == ((0, 1), {1: 3}, ["a", "c", "k", "a"], {1: 4, 3: 2})
    out = spec.apply(df, "v")
    got = {r.id: list(r.v) for r in out.select("id", "v").collect()}
    assert got == {1: [1.5, 2.0, 1.0, 0.0], 2: [-1e39, 3.0, 2.0, 1.0], 3: [9e38, 0.0, 3.0, 0.0]}
    attrs = out.schema["v"].metadata["ml_attr"]["attrs"]
    assert [a["idx"] for a in attrs["numeric"]] == [0, 2] and attrs["nominal"] == [
        {"idx": 1, "name": "c", "num_vals": 4}, {"idx": 3, "name": "a_missing", "num_vals": 2}]
    part = sliced(out, "v", [1, 2], "w")
    kept = part.schema["w"].metadata["ml_attr"]["attrs"]
    assert kept["nominal"][0]["num_vals"] == 4 and [list(r.w) for r in part.orderBy("id").collect()][1] == [3.0, 2.0]


def test_array_source_finds_missing_places(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, None]), (2, [float("nan"), 5.0, 6.0]), (3, None)], "id int, f array<float>")
    assert vector_spec(df.where("id < 3"), "f").missing == (0, 2)
    spec = vector_spec(df.where("id < 3"), "f")
    assert spec.features == ("f_0", "f_1", "f_2")
    assert [list(r.f) for r in spec.apply(df.where("id < 3"), "f").orderBy("id").collect()] == [
        [1.0, 2.0, -1e39, 0.0, 1.0], [-1e39, 5.0, 6.0, 1.0, 0.0]]
    all_numbers = VectorSpec(("id",), ("id",))
    assert [list(r.v) for r in all_numbers.apply(df.select(F.lit(None).cast("double").alias("id")).limit(1), "v").collect()] == [[-1e39]]


def _learnt(spark, n=500):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        x, c = float(rng.normal()), int(rng.integers(0, 6))
        rows.append((i, x if i % 9 else None, float(c), float(rng.normal()), int(x + (c in (1, 4)) + 0.7 * rng.normal() > 0.5)))
    return spark.createDataFrame(rows, "id long, x double, c double, z double, y int")


def test_staged_scores_are_those_of_the_cut_models(spark):
    df = _learnt(spark)
    prepared = prepare(df, ["x", "c", "z"], "y", ["id"], folds=3, nominal={"c": 6})
    cv = cross_validate_prepared(prepared, max_iter=4, max_depth=3, staged=True)
    staged = staged_scores(cv.models, prepared.data, "__vector", ["__o0", "__label"], "__fold")
    got = {(r.fold, r["round"], r["__o0"]): r.raw for r in staged.collect()}
    assert len(got) == 4 * 500
    for k, model in cv.models.items():
        held = prepared.data.where(F.col("__fold") == k)
        for r in (1, 2, 4):
            want = margins(cut_model(model, r), held, ["__o0"])
            assert cut_model(model, r).getNumTrees == r
            assert all(math.isclose(got[k, r, i[0]], m, rel_tol=1e-12, abs_tol=1e-12) for i, m in want.items())
    by_all = staged_scores({0: cv.models[0]}, prepared.data, "__vector", ["__o0"], None)
    assert by_all.count() == 4 * 500
    # Two rounds of the metric by hand.
    rounds = {(r.fold, r["round"]): r.metric for r in cv.rounds.collect()}
    label = {r["__o0"]: r["__label"] for r in prepared.data.collect()}
    for k, r in ((0, 1), (2, 3)):
        order = sorted(((-s, i) for (f, n, i), s in got.items() if f == k and n == r))
        y = np.array([label[i] for _, i in order])
        w = 20 - 19 * y
        share, lorenz, pos, neg = np.cumsum(w) / w.sum(), np.cumsum(y) / y.sum(), y.sum(), len(y) - y.sum()
        gini = ((lorenz - share) * w).sum() / (10 * neg * (1 - 19 / (pos + 20 * neg)))
        assert math.isclose(rounds[k, r], (gini + y[share <= 0.04].sum() / pos) / 2, rel_tol=1e-9)
    table = cv_rounds(cv)
    assert table.count() == 3 * 4 + 4 and table.where("fold is null").count() == 4
    means = [r.metric for r in table.where("fold is null").orderBy("round").collect()]
    assert means == pytest.approx(cv.curve)
    assert node_table(cv.models).select("fold", "tree").distinct().count() == 12


def test_best_round():
    assert best_round([0.1, 0.3, 0.2, 0.4]) == 4
    assert best_round([0.1, 0.3, 0.2, 0.2, 0.4], patience=2) == 2
    assert best_round([0.1, 0.3, 0.2, 0.4], patience=2) == 4
    assert best_round([0.3, 0.2, 0.1], maximise=False) == 3 and best_round([0.2, 0.2, 0.2]) == 1
    assert best_round([float("nan"), 0.1, float("nan")]) == 2 and best_round([float("nan")] * 3) == 1 and best_round([]) == 0


def test_stopping_on_the_metric_where_the_loss_goes_on(spark, monkeypatch):
    df = _learnt(spark, 300)
    kw = {"folds": 2, "max_iter": 6, "max_depth": 2, "nominal": {"c": 6}}
    monkeypatch.setattr(selection, "mean_curve", lambda rounds: [0.1, 0.5, 0.4, 0.4, 0.4, 0.9])
    stopped = cross_validate(df, ["x", "c"], "y", ["id"], early_stopping=3, **kw)
    assert stopped.best == 2 and all(r.n_trees == 2 for r in stopped.scores.collect())
    patient = cross_validate(df, ["x", "c"], "y", ["id"], early_stopping=33, **kw)
    assert patient.best == 6 and all(r.n_trees == 6 for r in patient.scores.collect())
    by_loss = cross_validate(df, ["x", "c"], "y", ["id"], early_stopping=True, **kw)
    assert any(r.n_trees > 2 for r in by_loss.scores.collect()) and by_loss.rounds is None


def test_predict_is_the_sigmoid_of_the_raw_score(spark):
    df = _learnt(spark, 300)
    cv = cross_validate(df, ["x", "c"], "y", ["id"], nominal={"c": 6}, folds=2, max_iter=3)
    for r in predict(cv.models[0], df, cv.spec, raw="raw").collect():
        assert math.isclose(r.prediction, 1 / (1 + math.exp(-r.raw)), rel_tol=1e-12)
    twice = {r.id: r.prediction for r in predict(cv.models[0], df, cv.spec, link="probability").collect()}
    model = cv.models[0].copy().setFeaturesCol("v")
    for r in model.transform(cv.spec.apply(df, "v")).select("id", vector_to_array("probability")[1].alias("p")).collect():
        assert math.isclose(twice[r.id], r.p, rel_tol=1e-12)


def test_array_form_of_the_flagship_equals_its_columns(spark):
    from panelwise import catalog
    d = "/root/testdata/sf0.001"
    orders, target = catalog.t(spark, d, "orders"), catalog._target(spark, d)
    array, mapping = build_features(orders, catalog.ORDERS_SPEC, target, drop_key=False, as_array=True, return_mapping=True)
    wide = build_features(orders, catalog.ORDERS_SPEC, target, drop_key=False, mapping=mapping)
    names, sizes = feature_names(array), nominal_sizes(mapping)
    kw = {"folds": 2, "max_iter": 2, "nominal": sizes}
    by_array = cross_validate(array, "features", "target", ["o_custkey"], **kw)
    by_name = cross_validate(wide, names, "target", ["o_custkey"], **kw)
    assert list(by_array.spec.features) == names and by_array.spec.missing == by_name.spec.missing
    assert by_array.spec.nominal == by_name.spec.nominal and len(by_array.spec.nominal) > 20
    assert by_array.scores.collect() == by_name.scores.collect()
    a, b = ({(r.fold, r.feature): (r.gain, r.split) for r in cv.importances.collect()} for cv in (by_array, by_name))
    assert a == b


def test_no_rows_of_a_class_and_empty_columns(spark):
    df = spark.createDataFrame([(i, None, float(i), i % 2) for i in range(40)], "id long, gone double, x double, y int")
    cv = cross_validate(df, ["gone", "x"], "y", ["id"], folds=2, max_iter=2)
    assert cv.spec.missing == (0,) and all(not math.isnan(r.score) for r in cv.scores.collect())
