"""Sources and sinks (IO1-IO7). Thin by design: Spark's readers and
writers do the work; these fix the conventions (explicit CSV schema,
partitioned chunk layout, one report directory per round)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path  # noqa: F401  (part of this module's interface)

LABEL_SCHEMA = "customer_ID string, target int"


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """IO1/IO4/IO5: a Parquet panel (lazy; pruning and pushdown apply)."""
    return spark.read.parquet(path)


def read_labels_csv(spark: SparkSession, path: str, schema: str = LABEL_SCHEMA) -> DataFrame:
    """IO2: a label CSV with a header, read with an explicit schema."""
    return spark.read.csv(path, header=True, schema=schema)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO3."""
    df.write.mode(mode).parquet(path)


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk", mode: str = "overwrite") -> None:
    """IO6: one directory per chunk (``chunk=i``); reading one chunk back
    prunes the others."""
    df.write.mode(mode).partitionBy(chunk).parquet(path)


def read_chunk(spark: SparkSession, path: str, i: int | None = None, chunk: str = "chunk") -> DataFrame:
    df = spark.read.parquet(path)
    return df if i is None else df.where(F.col(chunk) == F.lit(i))


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO7: a small ranking report as one CSV file with a header."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)
