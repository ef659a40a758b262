"""Aggregations (AG1-AG3, AG5-AG7). All are map-side combined group-bys,
so a hot key costs one partial row per map task, not a gathered group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import CALENDAR_COLUMNS, SPAN_COLUMN, col, q

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def key_stats(df: DataFrame, key: str, categorical=(), numeric=None,
              date: str | None = "date", with_count: str | None = None) -> DataFrame:
    """AG1 + AG2: per key ``min_ max_ std_ var_ sum_`` of the numeric
    columns (sample std/var), ``min_ max_`` of the categorical ones and the
    span ``days_from_first_to_last_payment``. Output order: all min, all
    max, all std, all var, all sum, categorical min, categorical max, span.
    ``with_count`` adds the row count per key under that name (last).

    One aggregate and one read; text is compared by its UTF-8 bytes."""
    if numeric is None:
        ex = set(categorical) | set(CALENDAR_COLUMNS) | {key}
        numeric = [f.name for f in df.schema.fields
                   if f.name not in ex and isinstance(f.dataType, _NUMERIC)]
    cats = [c for c in categorical if c in df.columns]
    aggs = []
    for fn, name in (("min", "min_"), ("max", "max_"), ("stddev_samp", "std_"), ("var_samp", "var_"),
                     ("sum", "sum_")):
        aggs += [F.expr(f"{fn}({q(c)}) AS {q(name + c)}") for c in numeric]
    aggs += [F.expr(f"min({q(c)}) AS {q('min_' + c)}") for c in cats]
    aggs += [F.expr(f"max({q(c)}) AS {q('max_' + c)}") for c in cats]
    if date is not None and date in df.columns:
        aggs.append(F.datediff(F.max(col(date)), F.min(col(date))).alias(SPAN_COLUMN))
    if with_count:
        aggs.append(F.count(F.lit(1)).cast("int").alias(with_count))
    return df.groupBy(col(key)).agg(*aggs)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """AG3 / ST1."""
    return df.select(col(key)).distinct()


def label_totals(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """AG5: positives, negatives and rows (optionally per group)."""
    y = col(label).cast("long")
    aggs = [F.sum(y).alias("n_pos"), (F.count(F.lit(1)) - F.sum(y)).alias("n_neg"),
            F.count(F.lit(1)).alias("n")]
    return df.groupBy(*(by or [])).agg(*aggs)


def fold_stats(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """AG6: mean and population standard deviation of per-fold scores (or
    per-fold importances grouped by feature)."""
    return df.groupBy(*(by or [])).agg(F.avg(col(value)).alias("mean"),
                                       F.stddev_pop(col(value)).alias("std"))


def fold_sums(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """AG7: sum over folds (importances per feature)."""
    return df.groupBy(*by).agg(F.sum(col(value)).alias(value))
