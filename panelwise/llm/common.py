"""What the operators of this package share: reading a table, the written
scratch tables that cut lineage, null-safe text, and word patterns."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from panelwise.session import scratch_path

# A word is a maximal run of characters other than space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the functions of ``module`` to tasks by value, so that executors
    need numpy, pyarrow and the tokenizer libraries but not this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names;
    ``session.clear_scratch`` removes it."""
    return scratch_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: its rows survive the loss of executors and
    later plans read it instead of computing it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand at most ``rows`` rows to Python at once. Rows with texts are large;
    the default of 10,000 would hold a whole partition in memory three times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fields(df: DataFrame, names: list[str], more: str, prefix: str = "") -> StructType:
    """The schema of columns of ``df`` (renamed prefix0, prefix1, ... with a
    prefix) and of ``more``, a DDL string."""
    own = [StructField(f"{prefix}{i}" if prefix else n, df.schema[n].dataType) for i, n in enumerate(names)]
    return StructType(own + StructType.fromDDL(more).fields)


def returned_as(columns: list[str], results) -> list[str]:
    """The names under which an operator returns the columns it was asked for:
    their own, but ``given_<name>`` for one named like a result."""
    taken = {r.lower() for r in results}
    names = []
    for c in columns:
        while c.lower() in taken:
            c = f"given_{c}"
        taken.add(c.lower())
        names.append(c)
    return names


def asked_for(columns: list[str], results) -> list[Column]:
    """The columns that an operator was asked for, as it returns them."""
    return [F.col(c).alias(n) for c, n in zip(columns, returned_as(columns, results))]


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(col: str = "text") -> Column:
    """The UTF-8 length of a text; 0 for null."""
    return F.coalesce(F.octet_length(F.col(col)), F.lit(0)).cast("long")


def batches_of(column, limit: int):
    """Cut an Arrow string/binary column into (start, stop) ranges of at most
    about ``limit`` bytes, at least one row each."""
    import numpy as np
    import pyarrow.compute as pc

    n = len(column)
    if not n:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        done = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield start, stop
        start = stop
