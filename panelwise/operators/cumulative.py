"""Cumulative shares and top selections (CU1, SO3, SO4, SO5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import col
from .metric import best_first
from .scan import ordered_scan


def normalize_cumsum(df: DataFrame, column: str, tiebreak: list[str], name: str | None = None) -> DataFrame:
    """CU1: sort by ``column`` descending (ties by ``tiebreak`` ascending)
    and replace it (or add ``name``) with the cumulative share of its total.

    The running sum and the total both come from the distributed scan."""
    order = best_first(col(column), tiebreak)
    tot: dict = {}
    out = ordered_scan(df, order, sums={"__cum": col(column)}, totals=tot)
    total = tot.get("__cum") if tot.get("rows") else None
    target = name or column
    share = F.try_divide(F.col("__cum"), F.lit(float(total) if total is not None else None).cast("double"))
    return out.withColumn(target, share).drop("__cum")


def top_fraction(df: DataFrame, score: str, weight: Column, fraction: float, tiebreak: list[str]) -> DataFrame:
    """SO3: rows, best score first, while the cumulative normalised weight
    is at most ``fraction``."""
    order = best_first(col(score), tiebreak)
    tot: dict = {}
    out = ordered_scan(df, order, sums={"__cw": weight}, totals=tot)
    return out.where(F.try_divide(F.col("__cw"), F.lit(float(tot["__cw"]))) <= F.lit(fraction)).drop("__cw")


def top_share(df: DataFrame, value: str, name: str, fraction: float = 0.7) -> DataFrame:
    """SO4: the best ``int(fraction * n)`` rows by ``value`` (ties by
    ``name``). A share of the input has no bound, so the rows are numbered by
    the ordered scan and filtered, never gathered by a limit."""
    tot: dict = {}
    ranked = ordered_scan(df, best_first(col(value), [name]), count="__place", totals=tot)
    return ranked.where(F.col("__place") <= int(fraction * tot["rows"])).drop("__place")


def row_slice(df: DataFrame, order: list, start: int, stop: int, index: str = "__idx") -> DataFrame:
    """SO5: rows ``start <= i < stop`` (0-based) in ``order``."""
    from .scan import row_index
    out = row_index(df, order, name=index, start=0)
    return out.where((F.col(index) >= start) & (F.col(index) < stop)).drop(index)
