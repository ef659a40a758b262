"""Lag features between consecutive statements of a key (RN6-RN10, PR7).

All lag columns of one call share one window specification, so Spark plans
a single exchange and sort for them. Where every key is known to be small (a
panel cut to its periods, or a measured bound) that window is per key. Else the
rows are range-partitioned on (key, order), the last row of every partition is
copied to the next one (its halo), and the same window runs per (partition,
key): a key with a large share of the rows is spread over many tasks, whatever
the number of lag columns, and everything stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ieee_ratio, safe_ratio, transition
from ..spec import CALENDAR_COLUMNS, DEFAULT_BALANCE_COLUMNS, DEFAULT_PAYMENT_COLUMNS, col, q
from .scan import WINDOW_MAX_ROWS, largest_segment, materialize, ordered_scan

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_feature_columns(df: DataFrame, key: str, categorical, extra_exclude=()) -> list[str]:
    """Columns that get differences and ratios: numeric, not the key, not
    categorical, not calendar parts."""
    ex = set(categorical) | set(CALENDAR_COLUMNS) | {key} | set(extra_exclude)
    return [f.name for f in df.schema.fields
            if f.name not in ex and isinstance(f.dataType, _NUMERIC)]


def lag_diff(c: Column, prev: Column) -> Column:
    """RN6: x - previous x, as float; NULL if either side is NULL."""
    return (c - prev).cast("float")


def lag_ratio(c: Column, prev: Column, ieee: bool = False) -> Column:
    """RN7: x / previous x. Default: NULL for a zero denominator (the cleaned
    value); ``ieee=True`` keeps +-inf and NaN."""
    return ieee_ratio(c, prev) if ieee else safe_ratio(c, prev)


def _lag_exprs(df, key, numeric, categorical, prev_of, ieee, f32_first):
    diffs, ratios, trans = {}, {}, {}
    for c in numeric:
        cur = col(c)
        diffs["diff_" + c] = lag_diff(cur, prev_of(c))
        if f32_first:
            ratios["ratio_" + c] = lag_ratio(cur.cast("float"), prev_of(c).cast("float"), ieee).cast("float")
        else:
            ratios["ratio_" + c] = lag_ratio(cur, prev_of(c), ieee)
    for c in categorical:
        if c in df.columns:
            trans["diff_cat_" + c] = transition(col(c), prev_of(c))
    return diffs, ratios, trans


def diff_ratio(df: DataFrame, key: str, order: list[str], categorical=(), numeric=None,
               ieee: bool = False, fill_transitions: bool = False,
               float32_ratio: bool = False, largest: int | None = None,
               strategy: str = "auto") -> DataFrame:
    """RN9 (and RN10 with ``float32_ratio=True``): for every numeric column
    add ``diff_x`` (float) and ``ratio_x``; for every categorical column add
    the transition ``diff_cat_x`` = "current->previous". ``order`` are
    column names (optionally followed by `` DESC``) ordering a key's rows.

    Column order: RN9 appends diffs, ratios, transitions; RN10 appends
    transitions, ratios, diffs and takes the ratio of float-cast values.
    Built as one projection of SQL expressions sharing one window, so a
    statement table of hundreds of columns plans in one JVM call.

    ``strategy``: "window" has one window per key, for panels whose keys are
    bounded; "halo" spreads keys over range partitions; "auto" takes the
    window if the largest key has at most ``WINDOW_MAX_ROWS`` rows (``largest``:
    its rows, if the caller knows; else one aggregate measures them)."""
    if strategy == "auto":
        rows = largest if largest is not None else largest_segment(df, key)[0]
        strategy = "window" if rows <= WINDOW_MAX_ROWS else "halo"
    if numeric is None:
        numeric = numeric_feature_columns(df, key, categorical)
    order_sql = ", ".join(_order_sql(o) for o in order)
    given, by = df.columns, q(key)
    if strategy == "halo":
        df, by = with_halo(df, key, order), f"{_PART}, {q(key)}"
    w = f"OVER (PARTITION BY {by} ORDER BY {order_sql})"
    diffs, ratios, trans = [], [], []
    for c in numeric:
        x, prev = q(c), f"lag({q(c)}) {w}"
        diffs.append(f"CAST({x} - {prev} AS FLOAT) AS {q('diff_' + c)}")
        if float32_ratio:
            r = _ratio_sql(f"CAST({x} AS FLOAT)", f"CAST({prev} AS FLOAT)", ieee)
            ratios.append(f"CAST({r} AS FLOAT) AS {q('ratio_' + c)}")
        else:
            ratios.append(f"{_ratio_sql(x, prev, ieee)} AS {q('ratio_' + c)}")
    for c in categorical:
        if c in given:
            t = f"concat(CAST({q(c)} AS STRING), '->', CAST(lag({q(c)}) {w} AS STRING))"
            if fill_transitions:
                t = f"coalesce({t}, '')"
            trans.append(f"{t} AS {q('diff_cat_' + c)}")
    parts = trans + ratios + diffs if float32_ratio else diffs + ratios + trans
    if strategy == "halo":
        names = [*given, *[p.rsplit(" AS ", 1)[1].strip("`").replace("``", "`") for p in parts]]
        return df.selectExpr(*[q(c) for c in given], *parts, _HALO).where(~F.col(_HALO)).select(*[col(c) for c in names])
    return df.selectExpr(*[q(c) for c in given], *parts)


_PART, _HALO, _AT = "__lag_part", "__lag_halo", "__lag_at"


def with_halo(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows in range partitions of (key, order), numbered in ``__lag_part``,
    and in each partition also a copy of the row before its first one, marked
    in ``__lag_halo``. The range bounds split large keys; the partitions are written once, which
    fixes them."""
    sort = [col(key).asc(), *[col(o.partition(" ")[0]).desc() if o.lower().endswith(" desc") else col(o.partition(" ")[0]).asc() for o in order]]
    held = materialize(df.repartitionByRange(*sort).sortWithinPartitions(*sort)
                       .withColumns({_PART: F.spark_partition_id(), _AT: F.monotonically_increasing_id()}), "lags")
    own = [c for c in held.columns if c not in (_PART, _AT)]
    row = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(own)])
    last = held.groupBy(_PART).agg(F.max_by(row, F.col(_AT)).alias("r"))  # one row a partition
    following = last.withColumn("__next", F.lead(_PART).over(Window.orderBy(_PART))).where("__next IS NOT NULL")
    halo = following.select(*[F.col("r")[f"c{i}"].alias(c) for i, c in enumerate(own)], F.col("__next").alias(_PART), F.lit(True).alias(_HALO))
    return held.drop(_AT).withColumn(_HALO, F.lit(False)).unionByName(halo)


def _order_sql(o) -> str:
    if not isinstance(o, str):
        raise TypeError("order columns are given by name, e.g. ['rank'] or ['ts DESC']")
    name, _, direction = o.partition(" ")
    return f"{q(name)} {direction}".strip()


def _ratio_sql(x: str, prev: str, ieee: bool) -> str:
    num, den = f"CAST({x} AS DOUBLE)", f"CAST({prev} AS DOUBLE)"
    if not ieee:
        return f"try_divide({num}, {den})"
    return (f"CASE WHEN {den} = 0 THEN (CASE WHEN {num} > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {num} < 0 THEN CAST('-Infinity' AS DOUBLE) ELSE CAST('NaN' AS DOUBLE) END) "
            f"ELSE try_divide({num}, {den}) END")


def lag_features_scan(df: DataFrame, key: str, order: list, categorical=(), numeric=None,
                      ieee: bool = False) -> DataFrame:
    """RN9 over unbounded histories: the previous values come from the
    distributed segmented scan instead of a per-key window, so a key with a
    large share of all rows is split over many tasks."""
    if numeric is None:
        numeric = numeric_feature_columns(df, key, categorical)
    cats = [c for c in categorical if c in df.columns]
    lag_names = {"__prev_" + c: c for c in list(numeric) + cats}
    scanned = ordered_scan(df, order, segment=key, lags=lag_names)
    prev_of = lambda c: F.col("__prev_" + c)
    diffs, ratios, trans = _lag_exprs(scanned, key, numeric, cats, prev_of, ieee, False)
    exprs = {**diffs, **ratios, **trans}
    return scanned.withColumns(exprs).drop(*lag_names.keys())


def pairwise_gaps(df: DataFrame, balance=DEFAULT_BALANCE_COLUMNS,
                  payment=DEFAULT_PAYMENT_COLUMNS) -> DataFrame:
    """PR7: ``"{b}-{p}" = b - p`` for every balance column b and payment
    column p (names contain a hyphen; refer to them with ``spec.col``)."""
    return df.withColumns({f"{b}-{p}": col(b) - col(p) for b in balance for p in payment})
