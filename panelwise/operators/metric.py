"""Weighted ranking metric and scoring/loss tables (ME1-ME6).

Metric (top-4% capture and weighted Gini), with y the 0/1 label sorted by
prediction, best first: w = 20 - 19y, W = cumsum(w) / sum(w),
d = sum(y where W <= 0.04) / n_pos, L = cumsum(y) / n_pos,
G = sum((L - W) * w), G_max = 10 n_neg (1 - 19 / (n_pos + 20 n_neg)),
metric = (G / G_max + d) / 2.

The running sums come from the distributed scan, range-partitioned on
prediction and tie-break. The tie-break is not optional: it makes the result
defined where predictions tie, and it is what splits one prediction shared by
a third of all rows over many tasks. The rest is one global aggregate.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (beta_grad, beta_hess, clip, cross_entropy, cross_entropy_grad, cross_entropy_hess,
                         logistic_grad, logistic_hess, sigmoid)
from ..spec import col
from .ranges import Key
from .scan import ordered_scan

# fixed values of the metric: label weights 20 (negative) / 1 (positive), top share 0.04
NEG_WEIGHT = 20.0
TOP_SHARE = 0.04


def best_first(score: Column, tiebreak: list[str]) -> list[Key]:
    """Descending by ``score``, ties by ``tiebreak``."""
    if not tiebreak:
        raise ValueError("rows with equal scores need a tie-break column")
    return [Key(score, descending=True), *[Key(col(t)) for t in tiebreak]]


def ranking_metric_table(df: DataFrame, prediction: str, label: str, tiebreak: list[str],
                         raw_score: bool = False) -> DataFrame:
    """ME1/ME2 as a one-row table: ``amex``, ``default_rate`` (d) and
    ``gini`` (normalised G). NULL when a class is absent."""
    p = sigmoid(col(prediction)) if raw_score else col(prediction)
    y = col(label).cast("double")
    base = df.select(p.alias("__p"), y.alias("__y"), *[col(t) for t in tiebreak])
    w = F.lit(NEG_WEIGHT) - F.lit(NEG_WEIGHT - 1.0) * F.col("__y")
    order = best_first(F.col("__p"), tiebreak)
    tot: dict = {}
    scanned = ordered_scan(base.withColumn("__w", w), order, sums={"__cw": F.col("__w"), "__cy": F.col("__y")},
                           totals=tot)
    n_pos = float(tot.get("__cy", 0.0))
    n_neg = float(tot["rows"]) - n_pos
    total_w = n_pos + NEG_WEIGHT * n_neg
    if n_pos == 0 or n_neg == 0:
        null = F.lit(None).cast("double")
        return scanned.agg(null.alias("amex"), null.alias("default_rate"), null.alias("gini")).limit(1)
    W = F.col("__cw") / F.lit(total_w)
    L = F.col("__cy") / F.lit(n_pos)
    g_max = 10.0 * n_neg * (1.0 - 19.0 / (n_pos + 20.0 * n_neg))
    d = F.sum(F.when(W <= F.lit(TOP_SHARE), F.col("__y")).otherwise(F.lit(0.0))) / F.lit(n_pos)
    g = F.sum((L - W) * F.col("__w")) / F.lit(g_max)
    out = scanned.agg(d.alias("d"), g.alias("g"))
    return out.select(((F.col("g") + F.col("d")) * 0.5).alias("amex"), F.col("d").alias("default_rate"),
                      F.col("g").alias("gini"))


def ranking_metric_by(df: DataFrame, by: str, prediction: str, label: str, tiebreak: list[str],
                      raw_score: bool = False) -> DataFrame:
    """ME1 per group (e.g. per cross-validation fold) in one pass: a scan
    segmented by ``by`` plus one aggregate of class totals per group.
    Output: (by, amex, default_rate, gini); NULL where a class is absent."""
    p = sigmoid(col(prediction)) if raw_score else col(prediction)
    base = df.select(col(by), p.alias("__p"), col(label).cast("double").alias("__y"),
                     *[col(t) for t in tiebreak])
    w = F.lit(NEG_WEIGHT) - F.lit(NEG_WEIGHT - 1.0) * F.col("__y")
    order = best_first(F.col("__p"), tiebreak)
    scanned = ordered_scan(base.withColumn("__w", w), order, segment=by,
                           sums={"__cw": F.col("__w"), "__cy": F.col("__y")})
    totals = base.groupBy(col(by).alias("__by")).agg(F.sum("__y").alias("__np"),
                                                     (F.count(F.lit(1)) - F.sum("__y")).alias("__nn"))
    j = scanned.join(totals, col(by).eqNullSafe(F.col("__by")), "left").drop("__by")
    tw = F.col("__np") + F.lit(NEG_WEIGHT) * F.col("__nn")
    W = F.col("__cw") / tw
    L = F.try_divide(F.col("__cy"), F.col("__np"))
    g_max = F.lit(10.0) * F.col("__nn") * (F.lit(1.0) - F.lit(19.0) / tw)
    agg = j.groupBy(col(by)).agg(
        F.try_divide(F.sum(F.when(W <= F.lit(TOP_SHARE), F.col("__y")).otherwise(F.lit(0.0))),
                     F.first("__np")).alias("__d"),
        F.try_divide(F.sum((L - W) * F.col("__w")), F.first(g_max)).alias("__g"),
        F.first("__np").alias("__np"), F.first("__nn").alias("__nn"))
    ok = (F.col("__np") > 0) & (F.col("__nn") > 0)
    return agg.select(col(by), F.when(ok, (F.col("__g") + F.col("__d")) * 0.5).alias("amex"),
                      F.when(ok, F.col("__d")).alias("default_rate"), F.when(ok, F.col("__g")).alias("gini"))


def ranking_metric(df: DataFrame, prediction: str, label: str, tiebreak: list[str],
                   raw_score: bool = False) -> float | None:
    """ME1/ME2 as a number."""
    return ranking_metric_table(df, prediction, label, tiebreak, raw_score).collect()[0]["amex"]


class RankingMetricEvaluator(Evaluator):
    """ME3: the metric as an MLlib evaluator (larger is better).
    ``tiebreakCols`` order rows with one prediction and must be given. With
    ``rawScore=True`` the sigmoid is applied to the prediction first."""

    predictionCol = Param(Params._dummy(), "predictionCol", "score column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label column", TypeConverters.toString)
    rawScore = Param(Params._dummy(), "rawScore", "apply sigmoid first", TypeConverters.toBoolean)
    tiebreakCols = Param(Params._dummy(), "tiebreakCols", "tie-break columns", TypeConverters.toListString)

    def __init__(self, predictionCol: str = "probability_1", labelCol: str = "label",
                 rawScore: bool = False, tiebreakCols: list[str] | None = None):
        super().__init__()
        if not tiebreakCols:
            raise ValueError("give tiebreakCols: they order rows with one prediction")
        self._setDefault(predictionCol="probability_1", labelCol="label", rawScore=False, tiebreakCols=[])
        self._set(predictionCol=predictionCol, labelCol=labelCol, rawScore=rawScore,
                  tiebreakCols=list(tiebreakCols or []))

    def _evaluate(self, dataset: DataFrame) -> float:
        v = ranking_metric(dataset, self.getOrDefault(self.predictionCol), self.getOrDefault(self.labelCol),
                           self.getOrDefault(self.tiebreakCols), self.getOrDefault(self.rawScore))
        return float("nan") if v is None else float(v)

    def isLargerBetter(self) -> bool:
        return True


def loss_columns(df: DataFrame, target: str, raw: str, beta: float = 2.0, eps: float = 1e-7) -> DataFrame:
    """ME5/ME6 per row: probability, clipped cross-entropy with its
    gradient and Hessian in p, the logistic gradient/Hessian in the raw
    score and the beta-weighted ones."""
    t = col(target).cast("double")
    p = sigmoid(col(raw))
    pc = clip(p, eps, 1.0 - eps)
    return df.withColumns({
        "p": p,
        "ce": cross_entropy(t, pc, eps),
        "ce_grad": cross_entropy_grad(t, pc, eps),
        "ce_hess": cross_entropy_hess(t, pc, eps),
        "logit_grad": logistic_grad(t, col(raw)),
        "logit_hess": logistic_hess(t, col(raw)),
        "beta_grad": beta_grad(t, col(raw), beta),
        "beta_hess": beta_hess(t, col(raw), beta),
    })

