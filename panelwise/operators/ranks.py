"""Ranks, indices and positional glue (RN1-RN5, JN3-JN6, AG4).

Per-key positions are computed without ever holding a whole key in one task:
the latest ``periods`` rows come from a row-number window that Spark plans
with a *partial* group limit before the shuffle (each map task forwards at
most ``periods`` rows per key), and per-key counts are partial aggregates.
Positions over unbounded histories use the distributed ``ordered_scan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import COUNT_COLUMN, RANK_COLUMN, PanelSpec, col
from .scan import WINDOW_MAX_ROWS, largest_segment, ordered_scan, row_index

_RN = "__rn_desc"


def key_counts(df: DataFrame, key: str, name: str = COUNT_COLUMN) -> DataFrame:
    """Rows per key, one row per key (map-side combined)."""
    return df.groupBy(col(key)).agg(F.count(F.lit(1)).cast("int").alias(name))


def latest_periods(df: DataFrame, spec: PanelSpec, counts: DataFrame | None = None,
                   with_count: bool = True, before: int = 0) -> DataFrame:
    """The most recent ``spec.periods`` statements of every key and, with
    ``before``, that many earlier ones (for lags), ranked as by ``add_rank``;
    ``total_number`` counts all statements of the key.

    Output columns: key, rank, the other columns, total_number (left out
    with ``with_count=False``, which also drops the count join)."""
    p = spec.periods
    w = Window.partitionBy(col(spec.key)).orderBy(*spec.order_columns(descending=True))
    top = df.withColumn(_RN, F.row_number().over(w))
    if not spec.bounded:
        # planned as a partial group limit before the shuffle: a hot key sends
        # at most ``periods + before`` rows per map task
        top = top.filter(F.col(_RN) <= p + before)
    top = top.withColumn(RANK_COLUMN, (F.lit(p + 1) - F.col(_RN)).cast("int"))
    rest = [c for c in df.columns if c not in (spec.key, RANK_COLUMN)]
    if not with_count:
        return top.select(spec.key, RANK_COLUMN, *[col(c) for c in rest])
    counts = counts if counts is not None else key_counts(df, spec.key)
    counts = counts.select(col(spec.key).alias("__key"), COUNT_COLUMN)
    top = top.join(counts, col(spec.key).eqNullSafe(F.col("__key")), "left").drop("__key")
    return top.select(spec.key, RANK_COLUMN, *[col(c) for c in rest], COUNT_COLUMN)


def add_rank(df: DataFrame, spec: PanelSpec, largest: int | None = None) -> DataFrame:
    """RN1: every statement with its rank in its key, counted so that the
    latest has rank ``periods``; statements before the first period have
    ranks 0, -1, ... Adds ``total_number``, the key's statements.

    Positions come from the ordered scan, so a hot key is spread over tasks;
    they are counted from the first statement and shifted by the count. If the
    largest key (``largest`` rows; measured if not given) fits a task, two windows
    over one exchange give position and count."""
    order = spec.order_columns()
    largest = largest if largest is not None else largest_segment(df, spec.key)[0]
    if largest <= WINDOW_MAX_ROWS:
        w = Window.partitionBy(col(spec.key)).orderBy(*spec.order_columns(descending=True))
        both = df.withColumns({_RN: F.row_number().over(w), COUNT_COLUMN: F.count(F.lit(1)).over(Window.partitionBy(col(spec.key))).cast("int")})
        rank = (F.lit(spec.periods + 1) - F.col(_RN)).cast("int").alias(RANK_COLUMN)
        return both.select(spec.key, rank, *[col(c) for c in df.columns if c not in (spec.key, RANK_COLUMN)], COUNT_COLUMN)
    scanned = ordered_scan(df, order, segment=spec.key, count="__pos", largest=largest)
    counts = key_counts(df, spec.key).withColumnRenamed(spec.key, "__key")
    j = scanned.join(counts, col(spec.key).eqNullSafe(F.col("__key")), "left").drop("__key")
    rank = (F.col("__pos") - F.col(COUNT_COLUMN) + F.lit(spec.periods)).cast("int").alias(RANK_COLUMN)
    rest = [c for c in df.columns if c not in (spec.key, RANK_COLUMN)]
    return j.select(spec.key, rank, *[col(c) for c in rest], COUNT_COLUMN)


def full_ranks(df: DataFrame, spec: PanelSpec, counts: DataFrame | None = None) -> DataFrame:
    """RN2: RN1 padded so that every key has all ranks 1..periods; a missing
    period is a row of NULLs (rank and key filled in). No statement is lost:
    ranks below 1 stay.

    The key x rank grid is generated from the one-row-per-key count table
    with ``sequence``+``explode`` (no cross join)."""
    ranked = add_rank(df, spec)
    counts = counts if counts is not None else key_counts(df, spec.key)
    grid = counts.select(col(spec.key).alias("__key"),
                         F.explode(F.sequence(F.lit(1), F.lit(spec.periods))).alias("__rank"))
    out = ranked.join(grid, col(spec.key).eqNullSafe(F.col("__key")) & (F.col(RANK_COLUMN) == F.col("__rank")), "full")
    rest = [c for c in ranked.columns if c not in (spec.key, RANK_COLUMN)]
    padded = F.col("__rank").isNotNull()  # the grid's key stands for a NULL key too
    return out.select(F.when(padded, F.col("__key")).otherwise(col(spec.key)).alias(spec.key),
                      F.coalesce(RANK_COLUMN, "__rank").alias(RANK_COLUMN), *[col(c) for c in rest])


def add_index(df: DataFrame, order: list, name: str = "index") -> DataFrame:
    """RN3: 1..n in the given order (distributed prefix count)."""
    return row_index(df, order, name=name, start=1)


def index_and_count(df: DataFrame, key: str, order: list, name: str = "index",
                    count_name: str = "count") -> DataFrame:
    """RN4: per-key row count, and the running sum (in ``order``) of the
    existing index column ``name``; without one, a column of ones is summed,
    giving 1..n."""
    counts = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias(count_name))
    if name in df.columns:
        with_idx = ordered_scan(df, order, sums={"__isum": col(name)})
        with_idx = with_idx.withColumn(name, F.col("__isum").cast(df.schema[name].dataType)).drop("__isum")
    else:
        with_idx = add_index(df, order, name=name)
    counts = counts.withColumnRenamed(key, "__key")
    return with_idx.join(counts, col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def rank_df(df: DataFrame, key: str, order: list[str], rank: str = RANK_COLUMN,
            index: str = "index") -> DataFrame:
    """RN5: ordinal position of each row inside its key (ascending
    ``order`` column names) and a global index 1..n over (key, order).
    Output: index, key, rank."""
    scanned = ordered_scan(df.select(col(key), *[col(c) for c in order if c != key]),
                           list(order), segment=key, count=rank, index=index)
    return scanned.select(index, key, F.col(rank).cast("int").alias(rank))


def rescale_rank(indexed: DataFrame, ranks: DataFrame, key: str = "customer_ID",
                 periods: int = 13, count: str = "count", rank: str = RANK_COLUMN,
                 index: str = "index") -> DataFrame:
    """JN6: join per-row ranks by row index and shift them so that the
    last row of each key gets ``periods``; output key, count, rank, rest."""
    j = indexed.join(ranks.drop(key), on=index, how="inner")
    j = j.withColumn(rank, (F.col(rank) - F.col(count) + F.lit(periods)).cast("int"))
    rest = [c for c in j.columns if c not in (key, count, rank, index)]
    return j.select(key, count, rank, *[col(c) for c in rest])


def positional_join(left: DataFrame, right: DataFrame, left_order: list, right_order: list) -> DataFrame:
    """JN5: glue two tables row by row: the i-th row of ``left`` (in
    ``left_order``) with the i-th row of ``right``; the shorter side wins."""
    a = add_index(left, left_order, name="__pos")
    b = add_index(right, right_order, name="__pos")
    return a.join(b, on="__pos", how="inner").drop("__pos")


def group_positions(df: DataFrame, key: str, order: list, name: str = "position") -> DataFrame:
    """AG4 without lists: the position each row would have in its key's
    ordered list (1-based) - the list-then-explode round trip of the
    reference, computed as a segmented scan so no key is gathered."""
    return ordered_scan(df, order, segment=key, count=name)
