"""Sources and sinks round trips (IO1-IO7)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelwise.operators import split
from panelwise.sources import io


def test_chunks_written_and_pruned(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    labeled = split.chunk_labels(o, "o_custkey", 5)
    path = str(tmp_path / "chunks")
    io.write_chunks(labeled, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("chunk=")) == \
        sorted(f"chunk={i}" for i in range(labeled.select("chunk").distinct().count()))
    one = io.read_chunk(spark, path, 0)
    assert "PartitionFilters: [isnotnull(chunk" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == labeled.where("chunk = 0").count()
    assert io.read_chunk(spark, path).count() == o.count()


def test_boundary_split_written_both_sides(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = str(tmp_path / "split")
    split.write_boundary_split(o, "o_custkey", path, 0.75)
    train, hold = split.read_split(spark, path, "train"), split.read_split(spark, path, "holdout")
    assert train.count() + hold.count() == o.count()
    assert train.select("o_custkey").intersect(hold.select("o_custkey")).count() == 0
    assert train.count() >= int(0.75 * o.count())


def test_labels_csv_and_report(spark, tmp_path):
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    p = str(tmp_path / "labels")
    lab.write.option("header", True).csv(p)
    back = io.read_labels_csv(spark, p, schema="doc_id bigint, quality int, toxic int")
    assert back.exceptAll(lab).count() == 0 and lab.exceptAll(back).count() == 0
    rp = str(tmp_path / "report")
    io.write_report_csv(lab.groupBy("quality").count().orderBy(F.desc("count")), rp)
    assert len([f for f in os.listdir(rp) if f.endswith(".csv")]) == 1


def test_table_equality_is_by_rows(spark):
    from panelwise.operators.clean import assert_frames_equal
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "n int, s string")
    assert_frames_equal(a, a.orderBy("s"))
    for other in (a.distinct(), a.unionAll(a.limit(1)), a.withColumnRenamed("s", "t")):
        with pytest.raises(AssertionError):
            assert_frames_equal(a, other)
