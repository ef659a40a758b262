"""The distributed ordered scan against Spark's single-task windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwise.operators.scan import ordered_scan, row_index
from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("strategy,parts", [("scan", 8), ("scan", None), ("scan", 37), ("window", None),
                                            ("auto", None)])
def test_segmented_scan_matches_window(spark, strategy, parts):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got = ordered_scan(o, ["o_orderdate", "o_orderkey"], segment="o_custkey", strategy=strategy,
                       num_partitions=parts,
                       sums={"cs": F.col("o_totalprice")}, count="n", index="i" if strategy == "scan" else None,
                       lags={"prev": "o_totalprice", "prevd": "o_orderdate"})
    got = got if strategy == "scan" else got.withColumn(
        "i", F.row_number().over(Window.orderBy("o_custkey", "o_orderdate", "o_orderkey")))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    ref = (o.withColumn("cs", F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("n", F.row_number().over(w)).withColumn("prev", F.lag("o_totalprice").over(w))
            .withColumn("prevd", F.lag("o_orderdate").over(w))
            .withColumn("i", F.row_number().over(Window.orderBy("o_custkey", "o_orderdate", "o_orderkey"))))
    cols = ["o_orderkey", F.round("cs", 4).alias("cs"), "n", "prev", "prevd", "i"]
    assert _rows(got, cols) == _rows(ref, cols)


@pytest.mark.parametrize("parts", [None, 8, 64])
def test_global_scan_matches_window_and_totals(spark, parts):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    tot = {}
    got = ordered_scan(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], num_partitions=parts,
                       sums={"cs": F.col("o_totalprice")}, count="n", lags={"prev": "o_orderkey"}, totals=tot)
    w = Window.orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    ref = (o.withColumn("cs", F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("n", F.row_number().over(w)).withColumn("prev", F.lag("o_orderkey").over(w)))
    cols = ["o_orderkey", F.round("cs", 2).alias("cs"), "n", "prev"]
    assert _rows(got, cols) == _rows(ref, cols)
    assert tot["rows"] == o.count()
    assert abs(tot["cs"] - o.agg(F.sum("o_totalprice")).first()[0]) < 1e-3


def test_hot_key_is_split_over_partitions(spark):
    # one key holds a third of all rows: the scan must not gather it in one task
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("t"), F.lit(1.0).alias("v"))
    got = ordered_scan(df, ["t"], segment="k", sums={"cv": F.col("v")}, count="n", num_partitions=8,
                       window_max_rows=n // 10)   # the hot key is above the bound: range-partitioned scan
    hot = got.where(F.col("k") == -1)
    assert hot.agg(F.max("n")).first()[0] == n // 3
    assert sorted(r[0] for r in hot.select("n").collect()) == list(range(1, n // 3 + 1))
    # the range exchange spread the hot key over several partitions
    spread = (df.repartitionByRange(8, "k", "t").where(F.col("k") == -1)
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1


def test_row_index_and_empty_partitions(spark):
    df = spark.range(5).select(F.col("id").alias("x"))
    out = row_index(df, ["x"], name="i", start=0)
    assert sorted((r.x, r.i) for r in out.collect()) == [(i, i) for i in range(5)]


def test_scratch_tables_are_removed(spark):
    import os
    from panelwise.session import clear_scratch, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    assert clear_scratch(spark) >= 1 and not os.path.exists(local)
