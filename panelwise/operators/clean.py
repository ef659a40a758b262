"""Column cleaning and small projections (PR8-PR10, PR13-PR16, CK1)."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import (DEFAULT_CATEGORICAL, FLOAT_TYPES, SIGNED_INT_TYPES, categorical_columns, col,
                    drop_regex, dtype_columns, q)

# patterns of the reference's first-period filter (fixed values)
FIRST_DIFF_PATTERN = r"^(?:diff_)(.*)(?:_1)$"
FIRST_RATIO_PATTERN = r"^(?:ratio_)(.*)(?:_1)$"
LEGACY_RATIO_PATTERN = r"^ratio_\w+$"


def ratio_columns(df: DataFrame, legacy: bool = False) -> list[str]:
    if legacy:
        rx = re.compile(LEGACY_RATIO_PATTERN)
        return [c for c in df.columns if rx.fullmatch(c)]
    return [c for c in df.columns if c.startswith("ratio_")]


def drop_first_period(df: DataFrame) -> DataFrame:
    """Drop ``diff_*_1`` and ``ratio_*_1`` (after a pivot these are the
    first-period lag features, which are always NULL)."""
    return drop_regex(df, FIRST_DIFF_PATTERN, FIRST_RATIO_PATTERN)


def filter_features(df: DataFrame, *, legacy_name_filter: bool = False, fill_null: bool = False,
                    categorical=DEFAULT_CATEGORICAL, order: list | None = None) -> DataFrame:
    """PR8. Column/value cleaning, no row is removed.

    (a) ``legacy_name_filter``: drop ``diff_*_1``/``ratio_*_1`` before the
        pivot, as the reference does (this hits base names ending in _1);
    (b) +-inf -> NULL in ratio columns (all of them; legacy: only names of
        word characters);
    (c) ``fill_null``: signed integer columns that are not categorical -> -1
        for NULL; categorical columns -> first-seen integer codes (``order``
        gives the row order that defines "first")."""
    if legacy_name_filter:
        df = drop_first_period(df)
    rc = set(ratio_columns(df, legacy=legacy_name_filter))
    if rc:
        inf = "CAST('Infinity' AS DOUBLE)"
        df = df.selectExpr(*[f"CASE WHEN abs({q(c)}) = {inf} THEN NULL ELSE {q(c)} END AS {q(c)}" if c in rc
                             else q(c) for c in df.columns])
    if fill_null:
        from .encode import first_seen_encode
        cats = categorical_columns(df, "both", categorical)
        ints = [c for c in dtype_columns(df, *SIGNED_INT_TYPES) if c not in cats]
        df = df.withColumns({c: F.coalesce(col(c), F.lit(-1).cast(df.schema[c].dataType)) for c in ints})
        if cats:
            df = first_seen_encode(df, cats, order or [])
    return df


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """PR9: NaN -> NULL in every float/double column."""
    fl = set(dtype_columns(df, *FLOAT_TYPES))
    if not fl:
        return df
    return df.selectExpr(*[f"CASE WHEN isnan({q(c)}) THEN NULL ELSE {q(c)} END AS {q(c)}" if c in fl else q(c)
                           for c in df.columns])


def narrow_doubles(df: DataFrame) -> DataFrame:
    """PR10: every double column -> float."""
    dbl = set(dtype_columns(df, "double"))
    if not dbl:
        return df
    return df.selectExpr(*[f"CAST({q(c)} AS FLOAT) AS {q(c)}" if c in dbl else q(c) for c in df.columns])


def fill_null(df: DataFrame, value, columns: list[str]) -> DataFrame:
    """PR16."""
    return df.withColumns({c: F.coalesce(col(c), F.lit(value)) for c in columns})


def row_sum(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """PR13: horizontal sum over columns (left fold from 0)."""
    return df.withColumn(name, reduce(add, [col(c) for c in columns], F.lit(0)))


def threshold_flags(df: DataFrame, columns: list[str], threshold: float = 0.999) -> DataFrame:
    """PR14: ``{c}_{threshold}`` = c < threshold (boolean)."""
    return df.withColumns({f"{c}_{threshold}": col(c) < F.lit(threshold) for c in columns})


def assert_frames_equal(left: DataFrame, right: DataFrame) -> None:
    """CK1: same multiset of rows (both directions of EXCEPT ALL are empty)
    and the same columns in the same order. Positional equality is not a
    meaningful notion for unordered tables."""
    if left.columns != right.columns:
        raise AssertionError(f"columns differ: {left.columns} vs {right.columns}")
    a = left.exceptAll(right).limit(1).count()
    b = right.exceptAll(left).limit(1).count()
    if a or b:
        raise AssertionError("tables differ")


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not matched in ``right`` (multiset difference)."""
    return left.exceptAll(right)
