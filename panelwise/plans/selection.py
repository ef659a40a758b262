"""Cross-validated boosted trees and feature selection on MLlib (ML1-ML4).

The reference drives native boosting libraries; here each fold is an MLlib
``GBTClassifier`` fit (a series of distributed Spark jobs). Folds come from
the stratified split (SP4), the score is the ranking metric (ME1) or the
accuracy, and importances are read from the fitted trees' own node table
(the Parquet the model writes), so per-feature gain *and* split counts are
aggregated by Spark instead of being walked on the driver.

Rows are prepared once (``prepare``): folds, label and one vector with nominal
and missing values (``training``), from named columns or the array form of the
feature build. The input is computed once and written; everything else reads
that. Selection rounds slice the vector, and a narrow slice is written as well:
every fold's fit reads its rows several times.

Driver work is the loop over folds and selection rounds only.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sigmoid
from ..operators.clean import row_sum, threshold_flags
from ..operators.metric import ranking_metric_by
from ..operators.scan import materialize
from ..operators.split import stratified_folds
from ..operators.stats import fold_stats
from ..sources.io import write_report_csv
from ..spec import col
from .training import (VectorSpec, best_round, cut_model, mean_curve, node_table, round_metrics, sliced, staged_scores,
                       vector_spec)

# fixed values of the reference's settings: 5 folds; selection keeps 0.7 of
# the features per round for at most 10 rounds; 3 boosting rounds per
# selection fit and stopping after 33 without a better one; 10 rounds for the
# plain cross-validation
FOLDS = 5
KEEP_FRACTION = 0.7
SELECTION_ROUNDS = 10
SELECTION_ITER = 3
SELECTION_PATIENCE = 33
CV_ITER = 10
NARROW = 10  # a slice of at most a tenth of the vector is written


@dataclass
class Prepared:
    """Rows ready for training, written once: ``__fold``, ``__label``, the
    vector ``__vector`` and the order columns."""

    data: DataFrame
    spec: VectorSpec
    order: list
    folds: int


@dataclass
class CrossValidation:
    """What cross-validation gives: the fitted model of each fold, scores and
    importances per fold, and their means and standard deviations. With
    per-round scores also ``rounds`` (fold, round, metric), ``curve`` (their
    mean over folds by round) and ``best`` (the round the models are cut to)."""

    models: dict
    scores: DataFrame
    importances: DataFrame
    mean: float
    std: float
    mean_importances: DataFrame
    spec: VectorSpec | None = None
    held_out: DataFrame | None = None
    rounds: DataFrame | None = None
    curve: list | None = None
    best: int | None = None


def tree_importance_long(models: dict, features: list[str]) -> DataFrame:
    """(fold, feature, gain, split) of fitted tree ensembles (fold -> model):
    total split gain and number of splits per feature, read from the node
    tables the models write, aggregated in one job. ``features`` names the
    feature of every slot of the vector; slots of one feature are added up."""
    spark = SparkSession.getActiveSession()
    internal = node_table(models).where(F.col("nodeData.leftChild") >= 0)
    per = internal.groupBy("fold", F.col("nodeData.split.featureIndex").alias("fi")).agg(
        F.sum("nodeData.gain").alias("gain"), F.count(F.lit(1)).alias("split"))
    grid = spark.createDataFrame([(k, i, f) for k in models for i, f in enumerate(features)],
                                 "fold int, fi int, feature string")
    full = grid.join(per, on=["fold", "fi"], how="left")
    return full.groupBy("fold", "feature").agg(F.sum(F.coalesce("gain", F.lit(0.0))).alias("gain"),
                                               F.sum(F.coalesce("split", F.lit(0))).cast("long").alias("split"))


def prepare(df: DataFrame, features: list[str] | str, label: str, order: list[str], *, folds: int = FOLDS,
            nominal: Mapping[str, int] | None = None) -> Prepared:
    """Folds, label and vector of every row, written once. ``features``:
    column names, or the name of an array column (``build_features`` with
    ``as_array=True``). ``nominal``: feature -> number of codes
    (``training.nominal_sizes``); all others are numbers."""
    array = isinstance(features, str)
    named = df.select(*[col(o).alias(f"__o{i}") for i, o in enumerate(order)], col(label).cast("double").alias("__y"),
                      *[col(c) for c in ([features] if array else dict.fromkeys(features))])
    rows = materialize(named, "rows")  # read for the missing values, the classes and the folds
    if array:
        rows = rows.withMetadata(features, df.schema[features].metadata or {})
    spec = vector_spec(rows, features, nominal)
    places = [f"__o{i}" for i in range(len(order))]
    folded = stratified_folds(rows, "__y", places, k=folds, name="__fold")
    data = materialize(spec.apply(folded, "__vector").select("__fold", F.col("__y").alias("__label"), "__vector", *places), "training")
    return Prepared(data.withMetadata("__vector", spec.metadata()), spec, places, folds)


def cross_validate(df: DataFrame, features: list[str] | str, label: str, order: list[str], *,
                   folds: int = FOLDS, max_iter: int = CV_ITER, max_depth: int = 3,
                   score: str = "metric", early_stopping: bool | int = False, seed: int = 0,
                   parallelism: int = FOLDS, nominal: Mapping[str, int] | None = None,
                   staged: bool = False) -> CrossValidation:
    """ML1: stratified k-fold GBT.

    scores (fold, score, n_rows, n_pos, n_trees): the ranking metric on the
    held-out fold, or the accuracy with ``score="accuracy"``; importances (fold, feature, gain,
    split), zero for unused features.

    ``early_stopping``: a number is the patience, in rounds, of stopping on the
    ranking metric's mean over the folds' held-out rows; all models are cut to
    the best round. All ``max_iter`` trees are fitted for that: the
    learner itself can only watch its loss, on each held-out fold alone, which is what ``True`` asks for.
    ``staged`` (implied by a number) adds the metric per fold and round."""
    prepared = prepare(df, features, label, order, folds=folds, nominal=nominal)
    return cross_validate_prepared(prepared, max_iter=max_iter, max_depth=max_depth, score=score,
                                   early_stopping=early_stopping, seed=seed, parallelism=parallelism, staged=staged)


def cross_validate_prepared(prepared: Prepared, columns: list[str] | None = None, *, max_iter: int = CV_ITER,
                            max_depth: int = 3, score: str = "metric", early_stopping: bool | int = False, seed: int = 0,
                            parallelism: int = FOLDS, staged: bool = False) -> CrossValidation:
    """:func:`cross_validate` of prepared rows, on the features named in ``columns``."""
    data, spec, folds = prepared.data, prepared.spec, prepared.folds
    spark = data.sparkSession
    vector, slots = "__vector", spec.slots
    if columns is not None and set(columns) != set(spec.features):
        places = spec.positions(columns)
        data = sliced(data, "__vector", places, "__slice").drop("__vector")
        if NARROW * len(places) <= len(slots):
            data = materialize(data, "slice").withMetadata("__slice", data.schema["__slice"].metadata)
        vector, slots = "__slice", [slots[i] for i in places]
    patience = early_stopping if not isinstance(early_stopping, bool) else None

    def fit(k: int):
        gbt = GBTClassifier(featuresCol=vector, labelCol="__label", maxIter=max_iter, maxDepth=max_depth,
                            maxBins=spec.max_bins, seed=seed)
        if early_stopping is True:
            train = data.withColumn("__valid", F.col("__fold") == k)
            gbt.setValidationIndicatorCol("__valid")
        else:
            train = data.where(F.col("__fold") != k)
        return k, gbt.fit(train)

    # folds are fitted concurrently (Spark runs jobs from several driver
    # threads at once), as MLlib's CrossValidator does with ``parallelism``
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, folds))) as pool:
        models = dict(pool.map(fit, range(folds)))
    rounds = curve = best = None
    if staged or patience is not None:
        scored = staged_scores(models, data, vector, ["__label", *prepared.order], "__fold")
        rounds = materialize(round_metrics(scored, "__label", prepared.order), "rounds")
        curve = mean_curve(rounds)
        best = best_round(curve, patience) if patience is not None else len(curve)
        if patience is not None:
            models = {k: cut_model(m, best) for k, m in models.items()}
    preds = None
    for k in range(folds):
        test = models[k].transform(data.where(F.col("__fold") == k))
        test = test.select("__fold", "__label", "prediction", *[col(o) for o in prepared.order],
                           vector_to_array("rawPrediction")[1].alias("__raw"))
        preds = test if preds is None else preds.unionByName(test)
    # every fold's held-out predictions scored in one pass
    if score == "accuracy":
        scores = preds.groupBy(F.col("__fold").alias("fold")).agg(
            F.avg((F.col("prediction") == F.col("__label")).cast("double")).alias("score"))
    else:
        scores = ranking_metric_by(preds, "__fold", "__raw", "__label", tiebreak=prepared.order) \
            .select(F.col("__fold").alias("fold"), F.coalesce("amex", F.lit(float("nan"))).alias("score"))
    sizes = data.groupBy(F.col("__fold").alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                            F.sum("__label").cast("long").alias("n_pos"))
    rows = [(int(r["fold"]), float(r["score"]), r["n_rows"], r["n_pos"], models[r["fold"]].getNumTrees)
            for r in scores.join(sizes, "fold").collect()]
    table = spark.createDataFrame(sorted(rows), "fold int, score double, n_rows long, n_pos long, n_trees int")
    mean, std = fold_stats(table, "score").first()
    importances = tree_importance_long(models, slots)
    return CrossValidation(models, table, importances, mean, std, fold_stats(importances, "gain", ["feature"]), spec,
                           preds, rounds, curve, best)


def predict(models, df: DataFrame, features: list[str] | VectorSpec, name: str = "prediction", raw: str | None = None,
            link: str = "sigmoid") -> DataFrame:
    """ME4: the sigmoid of a fitted model's raw score, or its mean over a
    fold -> model mapping (``CrossValidation.models``), added as ``name``.
    ``raw`` names a column for the (mean) raw score itself. The learner's own
    probability, the sigmoid of twice the raw score, is ``link="probability"``.
    ``features``: the training's ``CrossValidation.spec``, or columns of numbers."""
    if link not in ("sigmoid", "probability"):
        raise ValueError("link is 'sigmoid' or 'probability'")
    spec = features if isinstance(features, VectorSpec) else VectorSpec(tuple(features), tuple(features))
    out, scores, margins = spec.apply(df, "__vector"), [], []
    for i, model in enumerate(models.values() if isinstance(models, dict) else [models]):
        model = model.copy().setFeaturesCol("__vector").setRawPredictionCol("__r").setProbabilityCol("").setPredictionCol("")
        out = model.transform(out).withColumn(f"__m{i}", vector_to_array("__r")[1]).drop("__r")
        margins.append(F.col(f"__m{i}"))
        scores.append(sigmoid(F.col(f"__m{i}") * (1.0 if link == "sigmoid" else 2.0)))
    mean = lambda x: sum(x[1:], x[0]) / len(x)
    added = {name: mean(scores)} | ({raw: mean(margins)} if raw else {})
    return out.withColumns(added).drop("__vector", *[f"__m{i}" for i in range(len(margins))])


def cv_rounds(cv: CrossValidation) -> DataFrame:
    """(fold, round, metric) of a staged cross-validation, and under fold NULL
    the folds' mean of every round."""
    if cv.rounds is None:
        raise ValueError("cross-validate with staged=True or a patience")
    mean = cv.rounds.groupBy("round").agg(F.avg("metric").alias("metric"))
    return cv.rounds.unionByName(mean.select(F.lit(None).cast("int").alias("fold"), "round", "metric"))


def cv(df: DataFrame, features: list[str] | str, label: str, order: list[str], *, patience: int = 20, **kw) -> float:
    """ML1 as one number: the metric's mean over folds, averaged over the
    rounds up to the best one."""
    found = cross_validate(df, features, label, order, early_stopping=patience, **kw)
    return sum(found.curve[:found.best]) / found.best


def selection_round(df: DataFrame | Prepared, columns: list[str], label: str | None = None, order: list[str] | None = None,
                    importance: str = "gain", **kw):
    """ML2: CV on a column subset; returns (score, importances summed over
    folds as a (feature, feature_importance) table). The score is the
    metric's mean over folds, averaged over the rounds up to the best one.
    ``importance``: "gain" or "split". ``df``: prepared rows, or a table with ``label`` and ``order``."""
    prepared = df if isinstance(df, Prepared) else prepare(df, columns, label, order, folds=kw.pop("folds", FOLDS),
                                                           nominal=kw.pop("nominal", None))
    if kw.get("score", "metric") == "metric":
        kw.setdefault("early_stopping", SELECTION_PATIENCE)
    found = cross_validate_prepared(prepared, columns, max_iter=kw.pop("max_iter", SELECTION_ITER), **kw)
    summed = found.importances.groupBy("feature").agg(F.sum(importance).cast("double").alias("feature_importance"))
    score = found.mean if found.curve is None or found.best is None else sum(found.curve[:found.best]) / found.best
    return score, summed


def recursive_feature_elimination(df: DataFrame, features: list[str] | str, label: str, order: list[str], *,
                                  rounds: int = SELECTION_ROUNDS, keep: float = KEEP_FRACTION,
                                  report_dir: str | None = None, folds: int = FOLDS,
                                  nominal: Mapping[str, int] | None = None, rankings: list | None = None, **kw):
    """ML3: repeat ML2, keep the best ``int(keep * n)`` features by summed
    importance, write each round's ranking as CSV (``{report_dir}/
    feature_importance_{i:02}``). The round with one column is scored and is the last.
    Rows are prepared once; every round slices their vector.
    Returns (last ranking, best score, score per round); ``rankings`` collects
    every round's ranking table."""
    prepared = prepare(df, features, label, order, folds=folds, nominal=nominal)
    columns = list(prepared.spec.features)
    best, history, ranking = None, [], None
    for i in range(rounds):
        score, summed = selection_round(prepared, columns, **kw)
        history.append((i, len(columns), score))
        if score is not None and (best is None or score > best):
            best = score
        summed = materialize(summed, "importance")  # read by the report and the cut
        ranking = summed.select(F.col("feature").alias("columns"), "feature_importance") \
                        .orderBy(F.col("feature_importance").desc(), F.col("columns"))
        if rankings is not None:
            rankings.append(ranking)
        if report_dir:
            write_report_csv(ranking, f"{report_dir.rstrip('/')}/feature_importance_{i:02d}")
        n_keep = int(keep * len(columns))
        if n_keep < 1:
            break
        columns = [r["columns"] for r in ranking.limit(n_keep).collect()]
    return ranking, best, history


def importance_table(long: DataFrame, threshold: float = 0.999) -> DataFrame:
    """ML4: per feature ``gain_cv_NN``/``split_cv_NN`` for every fold in the
    table, their row sums turned into cumulative shares (``gain_cumsum``,
    ``split_cumsum``, best first), flags below ``threshold``; sorted by
    ``gain_cumsum``.

    One row per feature of a model: both shares come from plain windows over
    that table, whose size is the count of the model's columns."""
    folds = sorted(r["fold"] for r in long.select("fold").distinct().collect())
    sums = []
    for what, kind in (("gain", "double"), ("split", "long")):
        sums += [F.coalesce(F.sum(F.when(F.col("fold") == i, F.col(what))), F.lit(0)).cast(kind).alias(f"{what}_cv_{i:02d}")
                 for i in folds]
    wide = long.groupBy(F.col("feature").alias("columns")).agg(*sums)
    for what in ("gain", "split"):
        name = f"{what}_cumsum"
        wide = row_sum(wide, [f"{what}_cv_{i:02d}" for i in folds], name)
        order = Window.orderBy(F.col(name).desc(), F.col("columns")).rowsBetween(Window.unboundedPreceding, 0)
        share = F.try_divide(F.sum(name).over(order).cast("double"), F.sum(name).over(Window.partitionBy()))
        wide = wide.withColumn("__share", share).drop(name).withColumnRenamed("__share", name)
    wide = threshold_flags(wide, ["gain_cumsum", "split_cumsum"], threshold)
    wide = wide.withColumnRenamed(f"gain_cumsum_{threshold}", f"gain_{threshold}") \
               .withColumnRenamed(f"split_cumsum_{threshold}", f"split_{threshold}")
    return wide.orderBy("gain_cumsum", "columns")
