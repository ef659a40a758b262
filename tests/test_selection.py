"""Cross-validated boosting, importance table and feature elimination."""

import numpy as np
from pyspark.sql import functions as F

from panelwise.plans.selection import cross_validate, importance_table, predict, recursive_feature_elimination


def _data(spark, n=400):
    rng = np.random.default_rng(11)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    y = (x1 + 0.1 * rng.normal(size=n) > 0).astype(int)
    rows = [(i, float(a), float(b), float(i % 3), int(t)) for i, (a, b, t) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, x3 double, y int")


def test_cross_validate_scores_and_importances(spark):
    data = _data(spark)
    cv = cross_validate(data, ["x1", "x2", "x3"], "y", ["id"], max_iter=5)
    s = cv.scores.orderBy("fold").collect()
    assert [r.fold for r in s] == list(range(5)) and sum(r.n_rows for r in s) == 400
    assert all(r.score > 0.5 for r in s)           # x1 separates the classes
    assert all(r.n_trees == 5 for r in s)          # nothing stops early
    assert abs(cv.mean - np.mean([r.score for r in s])) < 1e-12 and abs(cv.std - np.std([r.score for r in s])) < 1e-12
    assert cv.mean_importances.count() == 3
    scored = predict(cv.models, data, ["x1", "x2", "x3"])
    assert scored.columns == [*data.columns, "prediction"]
    assert scored.where("(prediction > 0.5) = (y = 1)").count() > 380
    one = predict(cv.models[0], data, ["x1", "x2", "x3"]).agg(F.min("prediction"), F.max("prediction")).first()
    assert 0 <= one[0] < one[1] <= 1
    imps = cv.importances
    per = {r.feature: r.gain for r in imps.groupBy("feature").agg(F.sum("gain").alias("gain")).collect()}
    assert set(per) == {"x1", "x2", "x3"} and per["x1"] == max(per.values())
    acc = cross_validate(_data(spark), ["x1"], "y", ["id"], max_iter=3, score="accuracy")
    assert acc.scores.agg(F.min("score")).first()[0] > 0.8


def test_importance_table_shares_and_flags(spark):
    long = spark.createDataFrame(
        [(f, feat, g * (f + 1), s) for f in range(5) for feat, g, s in [("a", 10.0, 4), ("b", 1.0, 9), ("c", 0.0, 0)]],
        "fold int, feature string, gain double, split long")
    t = {r["columns"]: r for r in importance_table(long).collect()}
    assert t["a"]["gain_cv_04"] == 50.0 and t["b"]["split_cv_00"] == 9
    assert abs(t["a"]["gain_cumsum"] - 10 / 11) < 1e-12 and t["c"]["gain_cumsum"] == 1.0
    assert t["a"]["gain_0.999"] is True and t["c"]["gain_0.999"] is False
    assert abs(t["b"]["split_cumsum"] - 9 / 13) < 1e-12


def test_importance_table_of_ten_folds(spark):
    long = spark.createDataFrame([(f, "a", 1.0, 2) for f in range(10)], "fold int, feature string, gain double, split long")
    t = importance_table(long)
    assert sum(c.startswith("gain_cv_") for c in t.columns) == 10 and t.first()["split_cv_09"] == 2


def test_feature_elimination_writes_reports(spark, tmp_path):
    ranking, best, history = recursive_feature_elimination(_data(spark), ["x1", "x2", "x3"], "y", ["id"],
                                                           report_dir=str(tmp_path))
    assert [h[1] for h in history] == [3, 2, 1]    # 3 -> int(2.1)=2 -> int(1.4)=1, scored as well
    assert all(h[2] is not None for h in history)
    assert best is not None and best > 0.5
    assert (tmp_path / "feature_importance_00").exists() and (tmp_path / "feature_importance_01").exists()
    assert ranking.first()["columns"] == "x1"


def test_input_is_computed_once_and_fits_read_a_narrow_slice(spark):
    from panelwise.plans.selection import cross_validate_prepared, prepare
    seen = spark.sparkContext.accumulator(0)

    def counted(*x):
        seen.add(1)
        return [float("nan") if v is None else v for v in x] * 8

    names = [f"f{i}" for i in range(24)]
    data = _data(spark).withColumn("x2", F.when(F.col("id") % 7 > 0, F.col("x2")))
    data = data.select("id", "y", F.udf(counted, "array<double>")("x1", "x2", "x3").alias("v")).withMetadata("v", {"names": names})
    prepared = prepare(data, "v", "y", ["id"])
    assert seen.value == 400
    assert prepared.spec.features == tuple(names) and prepared.spec.missing == tuple(range(1, 24, 3))
    cv = cross_validate_prepared(prepared, ["f1", "f2"], max_iter=2)
    assert cv.held_out.count() == 400 and {r.feature for r in cv.importances.collect()} == {"f1", "f2"}
    assert all("/slice-" in f for f in cv.held_out.inputFiles())
