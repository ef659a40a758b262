"""What boosted trees need of a real panel: vectors with nominal and missing
values, made from columns or from the array form of the feature build, and
the score of every tree prefix (ML1-ML3).

* **Vectors.** ``VectorSpec`` turns named columns, or one ``array`` column with
  its names, into a vector with MLlib attribute metadata. Encoded categories
  become nominal attributes, so trees split them into sets instead of cutting
  their codes in order. A missing value (NULL or NaN) of a nominal
  feature is a category of its own; that of a number becomes the lowest value,
  and a two-valued slot beside it says that it was missing, so it can be split
  off however rare it is.
* **Subsets** are taken by slicing the vector (``sliced``); metadata goes along.
* **Rounds.** MLlib's own stopping watches the loss. Here a fitted ensemble's
  node tables (a few dozen nodes a tree) are evaluated with arrays in
  one pass over the rows, which gives the raw score after every tree; the metric per
  (fold, round) is one segmented scan. ``best_round`` finds where to stop and
  ``cut_model`` keeps the ensemble's first trees. Boosting adds trees one
  after the other, so the cut model is the one that stopping there gives.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metric import ranking_metric_by
from ..sources.io import scratch_path
from ..spec import col, q

# The per-partition function goes to executors by value.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with --py-files
    pass

LARGEST = 9e38     # infinities are cut to this; float columns end at 3.4e38
MISSING = -1e39    # the lowest value of every feature
MIN_BINS = 32      # MLlib's default; raised to the largest nominal feature
ROWS_AT_ONCE = 200_000  # scored (row, round) pairs that a task holds


@dataclass(frozen=True)
class VectorSpec:
    """How rows become vectors. ``source``: column names or the name of an
    array column; ``features``: their names in order; ``nominal``: feature
    position -> number of its codes; ``missing``: positions with missing values."""

    source: tuple | str
    features: tuple
    nominal: Mapping[int, int] = field(default_factory=dict)
    missing: tuple = ()

    @property
    def flagged(self) -> list[int]:
        """Numbers with missing values: each has a second slot, after all features."""
        return [p for p in self.missing if p not in self.nominal]

    @property
    def slots(self) -> list[str]:
        """The feature that each slot of the vector belongs to."""
        return [*self.features, *[self.features[p] for p in self.flagged]]

    @property
    def arity(self) -> dict[int, int]:
        """Slot -> number of categories of the nominal slots."""
        own = {p: n + (p in self.missing) for p, n in self.nominal.items()}
        return own | {len(self.features) + i: 2 for i in range(len(self.flagged))}

    @property
    def max_bins(self) -> int:
        return max([MIN_BINS, *self.arity.values()])

    def positions(self, names: list[str]) -> list[int]:
        """The slots of the named features, the features in the order of the spec."""
        wanted = set(names)
        return [i for i, n in enumerate(self.slots) if n in wanted]

    def apply(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with the vector column ``out``."""
        if isinstance(self.source, str):
            raw = f"transform({q(self.source)}, x -> CAST(x AS DOUBLE))"
        else:
            raw = f"array({', '.join(f'CAST({q(c)} AS DOUBLE)' for c in self.source)})"
        gone = "(x IS NULL OR isnan(x))"
        if self.missing:
            fills = ", ".join(f"CAST({self.nominal.get(i, MISSING)} AS DOUBLE)" for i in range(len(self.features)))
            clean = f"CASE WHEN {gone} THEN array({fills})[i] ELSE greatest(-{LARGEST}D, least(x, {LARGEST}D)) END"
        else:
            clean = f"CASE WHEN {gone} THEN {MISSING}D ELSE greatest(-{LARGEST}D, least(x, {LARGEST}D)) END"
        values = f"transform(__raw, (x, i) -> {clean})"
        if self.flagged:
            flags = f"transform(array({', '.join(map(str, self.flagged))}), p -> CASE WHEN __raw[p] IS NULL OR isnan(__raw[p]) THEN 1D ELSE 0D END)"
            values = f"concat({values}, {flags})"
        own = [q(c) for c in df.columns if c != out]
        made = df.selectExpr(*own, *([f"{q(self.source)} AS __source"] if self.source == out else []),
                             f"{raw} AS __raw").selectExpr(*own, f"{values} AS __x")
        vector = made.withColumn(out, array_to_vector("__x")).drop("__x")
        return vector.withMetadata(out, self.metadata())

    def metadata(self) -> dict:
        arity, used = self.arity, {}
        attrs: dict[str, list] = {"numeric": [], "nominal": []}
        for i, n in enumerate(self.slots):
            used[n] = used.get(n, 0) + 1
            name = n if used[n] == 1 else f"{n}_missing"
            if i in arity:
                attrs["nominal"].append({"idx": i, "name": name, "num_vals": arity[i]})
            else:
                attrs["numeric"].append({"idx": i, "name": name})
        return {"ml_attr": {"attrs": {k: v for k, v in attrs.items() if v}, "num_attrs": len(self.slots)}}


def vector_spec(df: DataFrame, features: list[str] | str, nominal: Mapping[str, int] | None = None) -> VectorSpec:
    """The spec of ``features``: column names, or an array column whose names
    are in its metadata (``build_features(..., as_array=True)``). ``nominal``: name -> number of codes.
    One aggregate finds the features with missing values."""
    if isinstance(features, str):
        names = (df.schema[features].metadata or {}).get("names")
        if names is None:
            n = df.agg(F.max(F.size(col(features)))).first()[0] or 0
            names = [f"{features}_{i}" for i in range(n)]
        x = q(features)
        places = f"filter(sequence(0, {len(names)} - 1), i -> {x}[i] IS NULL OR isnan({x}[i]))"
        found = df.selectExpr(f"explode({places}) AS p").distinct().collect() if names else []  # one row a feature at most
        missing = sorted(r["p"] for r in found)
    else:
        names = list(features)
        has = [f"coalesce(bool_or({q(c)} IS NULL OR isnan(CAST({q(c)} AS DOUBLE))), false) AS m{i}" for i, c in enumerate(names)]
        row = df.selectExpr(*has).first() if names else []
        missing = [i for i, m in enumerate(row) if m]
    at = {n: i for i, n in enumerate(names)}
    sizes = {at[n]: int(k) for n, k in (nominal or {}).items() if n in at}
    return VectorSpec(features if isinstance(features, str) else tuple(names), tuple(names), sizes, tuple(missing))


def nominal_sizes(mapping: DataFrame, names: list[str] | None = None) -> dict[str, int]:
    """Column -> number of codes, from an encoder's mapping (``encode``)."""
    if names is not None:
        mapping = mapping.where(F.col("column").isin(list(names)))
    return {r["column"]: int(r["n"]) for r in mapping.groupBy("column").agg((F.max("code") + 1).alias("n")).collect()}


def sliced(df: DataFrame, vector: str, positions: list[int], out: str) -> DataFrame:
    """``df`` with the chosen slots of a vector as ``out``, attributes included."""
    return VectorSlicer(inputCol=vector, outputCol=out, indices=list(positions)).transform(df)


def node_table(models: Mapping[int, GBTClassificationModel]) -> DataFrame:
    """(fold, tree, nodeData) of fitted ensembles, from what MLlib writes."""
    spark = SparkSession.getActiveSession()
    nodes = None
    for fold, model in models.items():
        path = scratch_path(spark, f"gbt-fold{fold}")
        model.write().overwrite().save(path)
        part = spark.read.parquet(f"{path}/data").select(F.lit(fold).alias("fold"), F.col("treeID").alias("tree"), "nodeData")
        nodes = part if nodes is None else nodes.unionByName(part)
    return nodes


class Tree:
    """One tree as arrays over its nodes; node 0 is the root."""

    def __init__(self, rows: list):
        import numpy as np
        rows = sorted(rows, key=lambda r: r["id"])
        at = {r["id"]: i for i, r in enumerate(rows)}
        inner = [r["leftChild"] >= 0 for r in rows]
        split = [r["split"] for r in rows]
        self.value = np.array([r["prediction"] for r in rows])
        self.feature = np.array([s["featureIndex"] if k else -1 for s, k in zip(split, inner)])
        self.left = np.array([at.get(r["leftChild"], 0) for r in rows])
        self.right = np.array([at.get(r["rightChild"], 0) for r in rows])
        self.nominal = np.array([k and s["numCategories"] >= 0 for s, k in zip(split, inner)])
        numbers = [list(s["leftCategoriesOrThreshold"]) if k else [] for s, k in zip(split, inner)]
        self.threshold = np.array([v[0] if k and not c else 0.0 for v, k, c in zip(numbers, inner, self.nominal)])
        width = max([s["numCategories"] for s, k in zip(split, inner) if k and s["numCategories"] > 0], default=1)
        self.to_left = np.zeros((len(rows), width + 1), dtype=bool)  # the last column: codes beyond, to the right
        for i, v in enumerate(numbers):
            if self.nominal[i]:
                self.to_left[i, [int(c) for c in v]] = True

    def predict(self, x):
        """The leaf value of every row of ``x``."""
        import numpy as np
        at, row = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at]
            v = x[row, np.maximum(f, 0)]
            with np.errstate(invalid="ignore"):
                code = np.clip(np.nan_to_num(v), 0, self.to_left.shape[1] - 1).astype(np.int64)
            left = np.where(self.nominal[at], self.to_left[at, code], v <= self.threshold[at])
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)


def staged_scores(models: Mapping[int, GBTClassificationModel], rows: DataFrame, vector: str, keep: list[str],
                  fold: str | None = "fold") -> DataFrame:
    """(fold, round, ``keep``, raw): the raw score (margin) of every row after
    1, 2, ... trees, by the model of the row's own fold, or by every model with
    ``fold=None``. One pass; rows of a fold without a model are left out."""
    trees: dict = {}
    for r in node_table(models).collect():  # a few dozen nodes a tree
        trees.setdefault((r["fold"], r["tree"]), []).append(r["nodeData"].asDict(recursive=True))
    ensembles = {k: [(float(w), Tree(trees[k, i])) for i, w in enumerate(m.treeWeights)] for k, m in models.items()}

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for whole in batches:
            longest = max((len(e) for e in ensembles.values()), default=1)
            step = max(1, ROWS_AT_ONCE // max(1, longest))
            for s in range(0, whole.num_rows, step):
                b = whole.slice(s, step)
                x = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                own = b.column(0).to_numpy(zero_copy_only=False) if fold is not None else None
                for k, ensemble in ensembles.items():
                    at = np.arange(b.num_rows) if own is None else np.flatnonzero(own == k)
                    if not len(at) or not ensemble:
                        continue
                    raw = np.cumsum([w * t.predict(x[at]) for w, t in ensemble], axis=0)
                    n = len(ensemble)
                    kept = [c.take(pa.array(np.tile(at, n))) for c in b.columns[1:-1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n * len(at), k, dtype=np.int32)), pa.array(np.repeat(np.arange(1, n + 1, dtype=np.int32), len(at))),
                         *kept, pa.array(raw.ravel())], names=["fold", "round", *keep, "raw"])

    own = (col(fold) if fold is not None else F.lit(0)).cast("int").alias("__own")
    given = rows.select(own, *[col(c) for c in keep], vector_to_array(col(vector)).alias("__x"))
    shape = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("round", T.IntegerType()),
                          *[rows.schema[c] for c in keep], T.StructField("raw", T.DoubleType())])
    return given.mapInArrow(run, shape)


def round_metrics(staged: DataFrame, label: str, order: list[str]) -> DataFrame:
    """(fold, round, metric) of staged scores: the ranking metric of every
    (fold, round) in one segmented scan; NULL where a class is absent."""
    by = staged.withColumn("__seg", F.col("fold").cast("long") * (1 << 31) + F.col("round"))
    found = ranking_metric_by(by, "__seg", "raw", label, tiebreak=order)
    return found.select(F.floor(F.col("__seg") / (1 << 31)).cast("int").alias("fold"),
                        (F.col("__seg") % (1 << 31)).cast("int").alias("round"), F.col("amex").alias("metric"))


def mean_curve(rounds: DataFrame) -> list[float]:
    """The metric's mean over folds, round by round (one number a round)."""
    rows = rounds.groupBy("round").agg(F.avg("metric").alias("m")).orderBy("round").collect()
    return [float("nan") if r["m"] is None else float(r["m"]) for r in rows]


def best_round(curve: list[float], patience: int | None = None, maximise: bool = True) -> int:
    """The round (from 1) that stopping keeps: rounds are looked at in turn
    until ``patience`` of them in a row have not improved on the best one. Equal
    scores do not improve; NaN never does. 0 for an empty curve."""
    best, at = None, 0
    for i, v in enumerate(curve, 1):
        if v == v and (best is None or (v > best if maximise else v < best)):
            best, at = v, i
        elif patience is not None and i - max(at, 1) >= patience:
            break
    return at or min(1, len(curve))


def cut_model(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble of the model's first ``rounds`` trees."""
    weights = list(model.treeWeights)
    if rounds >= len(weights):
        return model
    if rounds < 1:
        raise ValueError("an ensemble has one tree at least")
    spark = SparkSession.getActiveSession()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    java = model._java_obj
    trees, own = java.trees(), jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    some, some_weights = gateway.new_array(own, rounds), gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        some[i], some_weights[i] = trees[i], float(weights[i])
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_{rounds}", some, some_weights, int(model.numFeatures), 2)
    cut.setFeaturesCol(model.getFeaturesCol())
    return GBTClassificationModel(cut)
