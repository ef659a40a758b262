"""Ranking metric on small fixtures worked out by hand, and its invariants."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from panelwise.operators.cumulative import normalize_cumsum, top_fraction, top_share
from panelwise.operators.metric import (RankingMetricEvaluator, ranking_metric, ranking_metric_by,
                                        ranking_metric_table)


def scored(spark, labels, step=1.0):
    """Rows in the given order, best prediction first."""
    return spark.createDataFrame([(i, -step * i, y) for i, y in enumerate(labels)], "id long, prediction double, target int")


def test_two_rows_by_hand(spark):
    # Positive first: weights 1, 20 of 21. W = 1/21, 1; L = 1, 1; d = 0 (1/21 > 0.04).
    # G = (1 - 1/21) + 0 = 20/21; G_max = 10 * 1 * (1 - 19/21) = 20/21; metric = 1/2.
    t = ranking_metric_table(scored(spark, [1, 0]), "prediction", "target", ["id"]).first()
    assert (t["amex"], t["default_rate"], t["gini"]) == pytest.approx((0.5, 0.0, 1.0))
    # Negative first: W = 20/21, 1; L = 0, 1. G = -20/21 * 20; metric = -20/2.
    t = ranking_metric_table(scored(spark, [0, 1]), "prediction", "target", ["id"]).first()
    assert (t["amex"], t["default_rate"], t["gini"]) == pytest.approx((-10.0, 0.0, -20.0))


def test_perfect_order_has_gini_one(spark):
    # 3 positives, 2 negatives: total weight 43; W of the first positive 1/43 <= 0.04: d = 1/3.
    t = ranking_metric_table(scored(spark, [1, 1, 1, 0, 0]), "prediction", "target", ["id"]).first()
    # G = sum of (k/3 - k/43) for k = 1, 2, 3, then 20 * (1 - 23/43) and 0.
    g = 6 * (Fraction(1, 3) - Fraction(1, 43)) + 20 * (1 - Fraction(23, 43))
    g_max = 20 * (1 - Fraction(19, 43))
    assert t["default_rate"] == pytest.approx(1 / 3)
    assert t["gini"] == pytest.approx(float(g / g_max))
    assert t["amex"] == pytest.approx(float((g / g_max + Fraction(1, 3)) / 2))


def test_ties_follow_the_tie_break(spark):
    tied = scored(spark, [0, 1, 1, 0, 1, 0], step=0.0)
    split = scored(spark, [0, 1, 1, 0, 1, 0])
    assert ranking_metric(tied, "prediction", "target", ["id"]) == ranking_metric(split, "prediction", "target", ["id"])
    for call in (lambda: ranking_metric(tied, "prediction", "target", []), lambda: RankingMetricEvaluator("prediction", "target"),
                 lambda: normalize_cumsum(tied, "prediction", []), lambda: top_fraction(tied, "prediction", F.lit(1.0), 0.5, [])):
        with pytest.raises(ValueError):
            call()


def test_hot_score_is_spread(spark):
    n = 9000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / n).alias("prediction"),
                               (F.col("id") % 7 == 0).cast("int").alias("target"))
    ranged = df.repartitionByRange(8, F.col("prediction").desc(), F.col("id"))
    assert ranged.where("prediction = 0.5").select(F.spark_partition_id()).distinct().count() > 1
    assert ranking_metric(df, "prediction", "target", ["id"]) is not None


def test_evaluator_and_raw_scores(spark):
    df = scored(spark, [1, 0, 1, 1, 0, 0, 1, 0])
    plain = ranking_metric(df, "prediction", "target", ["id"])
    for raw in (False, True):  # a sigmoid keeps the order
        e = RankingMetricEvaluator(predictionCol="prediction", labelCol="target", rawScore=raw, tiebreakCols=["id"])
        assert e.evaluate(df) == pytest.approx(plain) and e.isLargerBetter()


def test_one_class_is_null(spark):
    assert ranking_metric(scored(spark, [1] * 10), "prediction", "target", ["id"]) is None


def test_top_share_boundary_exactly_four_percent(spark):
    # 5 negatives (20 each) before 400 positives, total 500: the first negative
    # ends at 20/500 = 0.04 exactly, which counts, but captures no positive
    t = ranking_metric_table(scored(spark, [0] * 5 + [1] * 400), "prediction", "target", ["id"]).first()
    assert t["default_rate"] == 0.0
    # 20 positives first reach 20/500 exactly: all of them count
    t = ranking_metric_table(scored(spark, [1] * 20 + [0] * 5 + [1] * 380), "prediction", "target", ["id"]).first()
    assert t["default_rate"] == pytest.approx(20 / 400)


def test_by_group_equals_single_groups(spark):
    rows = [(g, 100 * i + (g or 7), float((i * 37 + (g or 0)) % 50), int((i * i + (g or 0)) % 3 == 0)) for g in (0, 1, 2, None) for i in range(60)]
    rows += [(9, 9000 + i, float(i), 1) for i in range(5)]   # one class only
    df = spark.createDataFrame(rows, "g int, id long, prediction double, target int")
    by = {r["g"]: r["amex"] for r in ranking_metric_by(df, "g", "prediction", "target", ["id"]).collect()}
    for g in (0, 1, 2, None):
        own = df.where(F.col("g").eqNullSafe(F.lit(g)))
        assert by[g] == pytest.approx(ranking_metric(own, "prediction", "target", ["id"]))
    assert by[9] is None


def test_top_share_has_no_limit(spark):
    df = spark.createDataFrame([(f"f{i}", float(i % 5)) for i in range(20)], "name string, v double")
    top = top_share(df, "v", "name", 0.7)
    assert "TakeOrdered" not in top._jdf.queryExecution().executedPlan().toString()
    rows = sorted((-r["v"], r["name"]) for r in df.collect())[:14]
    assert sorted((-r["v"], r["name"]) for r in top.collect()) == rows
