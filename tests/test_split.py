"""Splits and folds by their properties and small cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from panelwise.operators import split

KEYS = "k long, j long"


def table(spark, sizes, nulls=0):
    rows = [(k, j) for k, n in enumerate(sizes) for j in range(n)] + [(None, j) for j in range(nulls)]
    return spark.createDataFrame(rows, KEYS)


def labels_of(df, name):
    """key -> its labels, checked to be one."""
    got = {}
    for r in df.groupBy("k").agg(F.collect_set(name).alias("l")).collect():
        assert len(r["l"]) == 1, "a key is divided"
        got[r["k"]] = r["l"][0]
    return got


@pytest.mark.parametrize("sizes,n,want", [
    ([3, 1, 4, 1, 5, 9, 2, 6], 3, [0, 0, 0, 0, 0, 1, 1, 2]),  # rows 0-13 (row 10 is in key 4), 14-24, 25-30
    ([1] * 7, 5, [0, 0, 1, 1, 2, 2, 3]),                       # 7 // 5 = 1: a chunk ends with the key after its first
    ([2, 2], 5, [0, 1]),
    ([10, 1, 1], 2, [0, 1, 1]),
    ([4], 3, [0]),
])
def test_chunks_by_hand(spark, sizes, n, want):
    got = labels_of(split.chunk_labels(table(spark, sizes), "k", n), "chunk")
    assert [got[k] for k in range(len(sizes))] == want


def test_chunks_are_contiguous_and_full(spark):
    sizes = [(7 * i) % 11 + 1 for i in range(60)]
    got = labels_of(split.chunk_labels(table(spark, sizes), "k", 6), "chunk")
    chunks = [got[k] for k in range(len(sizes))]
    assert chunks == sorted(chunks) and set(chunks) == set(range(max(chunks) + 1))
    step = sum(sizes) // 6
    for c in range(max(chunks)):  # all but the last hold more than a step, by at most one key
        inside = [s for s, x in zip(sizes, chunks) if x == c]
        assert step < sum(inside) <= step + max(inside)


def test_null_keys_stay(spark):
    df = table(spark, [3, 1, 4], nulls=5)
    assert labels_of(split.chunk_labels(df, "k", 3), "chunk") == {None: 0, 0: 1, 1: 1, 2: 1}
    assert labels_of(split.boundary_labels(df, "k", 0.5), "__train") == {None: True, 0: True, 1: False, 2: False}
    folds = split.stratified_folds(df, "k", ["j"], k=2)
    assert folds.count() == df.count() and folds.where("fold is null").count() == 0


@pytest.mark.parametrize("fraction,train", [(0.75, 4), (0.0, 0), (1.0, 6), (0.01, 0)])
def test_boundary_split(spark, fraction, train):
    # 22 rows starting at 0, 3, 8, 10, 17, 18: row 16 is inside key 3, so key 4 is the first holdout key
    df = table(spark, [3, 5, 2, 7, 1, 4])
    got = labels_of(split.boundary_labels(df, "k", fraction), "__train")
    assert [got[k] for k in range(6)] == [k < train for k in range(6)]
    a, b = split.boundary_split(df, "k", fraction)
    assert a.count() + b.count() == 22


def test_boundary_split_joins_nothing(spark):
    plan = split.boundary_labels(table(spark, [3, 5, 2]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_exact_split_sizes(spark):
    df = spark.range(1001).withColumnRenamed("id", "x")
    train, test = split.train_test_split(df, 0.75, tiebreak=["x"])
    assert train.count() == int(0.75 * 1001) and test.count() == 1001 - int(0.75 * 1001)
    assert train.join(test, "x").count() == 0


def test_folds_by_hand(spark):
    # y = b a a b a: b is class 0, a class 1; sorted classes b b a a a are dealt to folds 0 1 0 1 0
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "a")], "id long, y string")
    got = [r["fold"] for r in split.stratified_folds(df, "y", ["id"], k=2).orderBy("id").collect()]
    assert got == [0, 0, 0, 1, 1]


@pytest.mark.parametrize("n,classes,k", [(103, 2, 5), (57, 3, 5), (12, 4, 3), (40, 40, 4)])
def test_folds_are_balanced_contiguous_blocks(spark, n, classes, k):
    df = spark.createDataFrame([(i, (i * i + i // 3) % classes) for i in range(n)], "id long, y int")
    rows = split.stratified_folds(df, "y", ["id"], k=k).orderBy("id").collect()
    assert len(rows) == n
    whole = [sum(r["fold"] == f for r in rows) for f in range(k)]
    assert max(whole) - min(whole) <= 1
    for c in {r["y"] for r in rows}:
        folds = [r["fold"] for r in rows if r["y"] == c]
        assert folds == sorted(folds)
        each = [folds.count(f) for f in range(k)]
        assert max(each) - min(each) <= 1


def test_large_classes_are_split_over_tasks(spark):
    n = 320_000
    df = spark.range(n).selectExpr("id", "int(id % 10 = 0) AS y")
    folds = split.stratified_folds(df, "y", ["id"], k=5)
    plan = folds._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(__scan_pid#" in plan and "windowspecdefinition(y#" not in plan  # not one window, and so one task, a class
    got = folds.groupBy("y", "fold").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("z")).orderBy("y", "fold").collect()
    assert [r["n"] for r in got] == [n * 9 // 50] * 5 + [n // 50] * 5
    assert all(x["z"] < z["a"] for x, z in zip(got, got[1:]) if x["y"] == z["y"])
