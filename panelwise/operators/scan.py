"""Ordered scans at scale: running sums, running counts and lags over a
global order, optionally restarting at every value of a segment column.

A plain ``Window.orderBy(...)`` without ``partitionBy`` moves every row to one
task, and ``Window.partitionBy(key)`` puts a whole key in one task, which is a
straggler when one key holds a large share of the rows. The scan here is a
two-pass prefix computation instead, in one of two forms.

**Ranges** (rows of files changed one by one, ``ranges.recomputable``, and keys
whose direction is known: names and ``Key``): bounds from a small sample become
constants of the plan; a map-side combined aggregate of the narrow columns gives
every range's totals, and one window a range gives the running values. Rows are
shuffled once, all in the JVM; nothing is written, and columns that only pass
through are read once, by the last step.

**Arrow pass** (all other inputs, which have to be fixed first):

1. ``repartitionByRange`` on (segment, order): the sampled range bounds split
   a hot segment over many partitions; each partition is sorted locally.
2. One Arrow pass per partition computes the partition-local running values
   (``mapInArrow``; the pass-through columns are not converted).
3. The result is written as a Parquet table under the reliable checkpoint
   directory (``materialize``), so the partition ids and local values are
   fixed even if executors are lost.

In both, one row per range or partition (its last row) is brought to the driver
and turned into carry-in values, which are broadcast (bounded by the count of
ranges) and added.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .ranges import Key, as_keys, as_struct, comparable, deal, recomputable

# The per-partition Arrow function is shipped by value, so executors need
# only numpy/pandas/pyarrow, not this package on their Python path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with --py-files
    pass

_P = "__scan_"
# largest per-segment group that a single task may take with a plain window
WINDOW_MAX_ROWS = 1_000_000


def largest_segment(df: DataFrame, segment: str) -> tuple[int, int]:
    """(rows of the largest segment, all rows) - one map-side combined job."""
    r = (df.groupBy(F.col(segment)).agg(F.count(F.lit(1)).alias("n"))
           .agg(F.max("n").alias("m"), F.sum("n").alias("t")).first())
    return int(r["m"] or 0), int(r["t"] or 0)


def _window_scan(df, order, segment, sums, count, lags) -> DataFrame:
    w = Window.partitionBy(F.col(segment)).orderBy(*[_as_sort(o) for o in order])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outs = {}
    if count:
        outs[count] = F.row_number().over(w).cast("long")
    for nm, e in sums.items():
        outs[nm] = F.coalesce(F.sum(F.coalesce(e.cast("double"), F.lit(0.0))).over(run), F.lit(0.0))
    for nm, src in lags.items():
        outs[nm] = F.lag(F.col(src)).over(w)
    return df.withColumns(outs)


def _as_sort(c) -> Column:
    if isinstance(c, Key):
        return c.sort()
    return F.col(c).asc() if isinstance(c, str) else c


def _range_scan(work: DataFrame, order: list, segment: str | None, sum_names: list[str], lag_src: list[str],
                index: bool, totals_asked: bool, n: int | None) -> tuple[DataFrame, list] | None:
    """Range-local running values and the last row of every range, as the
    Arrow pass gives them; None if a key does not compare as a constant."""
    keys = as_keys(([Key(F.col(segment))] if segment else []) + list(order))
    fields = comparable(work, keys) if keys else None
    if fields is None:
        return None
    dealt, ranges = deal(work, fields, _P + "pid", n)
    by = [_P + "pid", *([segment] if segment else [])]
    sort = [k.sort() for k in keys]
    w = Window.partitionBy(*[F.col(c) for c in by]).orderBy(*sort[1 if segment else 0:])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outs = {_P + "cnt": F.row_number().over(w).cast("long"), _P + "first": F.lit(True)}
    if index:
        outs[_P + "pos"] = F.row_number().over(Window.partitionBy(F.col(_P + "pid")).orderBy(*sort)).cast("long") - 1
    for i, c in enumerate(sum_names):
        outs[_P + "sum" + str(i)] = F.sum(F.coalesce(F.col(c), F.lit(0.0))).over(run)
    for j, c in enumerate(lag_src):
        outs[_P + "lag" + str(j)] = F.lag(F.col(c)).over(w)

    if ranges == 1 and not totals_asked:
        return dealt.withColumns(outs), []  # nothing to carry
    # totals per range: rows, and of its last segment the rows, sums and last values
    totals = [F.count(F.lit(1)).alias(_P + "cnt")]
    totals += [F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(_P + "sum" + str(i)) for i, c in enumerate(sum_names)]
    if lag_src:
        values = F.struct(*[F.col(c).alias(f"c{j}") for j, c in enumerate(lag_src)])
        totals.append(F.max_by(values, as_struct(fields)).alias(_P + "lags"))
    tails = dealt.groupBy(*[F.col(c) for c in by]).agg(*totals)
    if segment:
        tails = tails.withColumn(_P + "key", as_struct(comparable(tails, keys[:1])))
        last = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(tails.columns[1:-1])])
        names = tails.columns[1:-1]
        tails = tails.groupBy(_P + "pid").agg(F.max_by(last, F.col(_P + "key")).alias("v"), F.count(F.lit(1)).alias("n"),
                                              F.sum(_P + "cnt").alias("rows"))
        tails = tails.select(_P + "pid", *[F.col("v")[f"c{i}"].alias(c) for i, c in enumerate(names)],
                             (F.col("n") == 1).alias(_P + "first"), (F.col("rows") - 1).alias(_P + "pos"))
    else:
        tails = tails.withColumns({_P + "first": F.lit(True), _P + "pos": F.col(_P + "cnt") - 1})
    got = []
    for r in sorted((r.asDict(recursive=False) for r in tails.collect()), key=lambda r: r[_P + "pid"]):
        r[_P + "last"] = list(r[_P + "lags"]) if lag_src else []
        got.append(r)
    return dealt.withColumns(outs), got


def materialize(df: DataFrame, name: str = "scan") -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table in a fresh folder
    under the session's reliable checkpoint directory and read it back
    (``session.clear_scratch`` removes such folders).
    Columnar and compressed (smaller than an RDD checkpoint), and later
    reads prune columns and push filters down. Names are written as
    positional ``c{i}`` because Parquet forbids some characters in names."""
    from ..sources.io import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    names = df.columns
    df.toDF(*[f"c{i}" for i in range(len(names))]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).toDF(*names)


def _local_scan(seg: str | None, sum_cols: list[str], lag_cols: list[str]):
    """Build the per-partition Arrow function."""

    def run(batches: Iterable[pa.RecordBatch]):
        st = {"pos": 0, "started": False, "changed_seen": False, "last_seg": None,
              "sums": [0.0] * len(sum_cols), "cnt": 0,
              "last": {c: None for c in lag_cols}}
        pending = None
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            cols = _scan_batch(rb, n, st, seg, sum_cols, lag_cols)
            if pending is not None:
                yield _emit(*pending, last=False)
            pending = (rb, cols)
        if pending is not None:
            yield _emit(*pending, last=True)

    return run


def _scan_batch(rb, n, st, seg, sum_cols, lag_cols):
    started = st["started"]
    if seg is not None:
        s = rb.column(seg)
        head = st["last_seg"] if started else s.slice(0, 1)
        changed = ~_equal(s, pa.concat_arrays([head, s.slice(0, n - 1)]))
        if not started:
            changed[0] = True
        st["last_seg"] = s.slice(n - 1, 1)
    else:
        changed = np.zeros(n, dtype=bool)
        changed[0] = not started
    # a change at the partition's very first row is its start, not a change
    inner = changed.copy()
    if not started:
        inner[0] = False
    first_seg = (np.cumsum(inner) == 0) & (not st["changed_seen"])
    st["changed_seen"] = bool(st["changed_seen"] or inner.any())
    gid = np.cumsum(changed)
    cont = gid == 0  # rows continuing the segment open at the end of the previous batch

    out = {}
    pos = np.arange(st["pos"], st["pos"] + n, dtype=np.int64)
    st["pos"] += n
    out[_P + "pos"] = pa.array(pos)
    out[_P + "first"] = pa.array(first_seg, type=pa.bool_())

    ones = pd.Series(np.ones(n, dtype=np.int64))
    cnt = ones.groupby(gid).cumsum().to_numpy()
    cnt[cont] += st["cnt"]
    st["cnt"] = int(cnt[-1])
    out[_P + "cnt"] = pa.array(cnt)

    for i, c in enumerate(sum_cols):
        v = pc.fill_null(rb.column(c), 0.0).to_numpy(zero_copy_only=False)  # NULL adds nothing, NaN stays
        cs = _running(v, gid)
        with np.errstate(invalid="ignore"):  # inf - inf is NaN, as in any sum
            cs[cont] += st["sums"][i]
        st["sums"][i] = float(cs[-1])
        out[_P + "sum" + str(i)] = pa.array(cs)

    starts = pa.array(changed, type=pa.bool_())
    for j, c in enumerate(lag_cols):
        arr = rb.column(c)
        head = st["last"][c] if st["last"][c] is not None else pa.nulls(1, arr.type)
        prev = pa.concat_arrays([head, arr.slice(0, n - 1)]) if n > 1 else head
        out[_P + "lag" + str(j)] = pc.if_else(starts, pa.nulls(n, arr.type), prev)
        st["last"][c] = arr.slice(n - 1, 1)
    st["started"] = True
    return out


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Element-wise equality on the original type, as Spark groups: NULL
    equals NULL, NaN equals NaN, -0.0 equals 0.0."""
    if pa.types.is_nested(a.type):
        return np.array([x == y for x, y in zip(a.to_pylist(), b.to_pylist())], dtype=bool)
    same = pc.fill_null(pc.equal(a, b), False)
    both = pc.and_(pc.is_null(a), pc.is_null(b))
    if pa.types.is_floating(a.type):
        both = pc.or_(both, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return pc.or_(same, both).to_numpy(zero_copy_only=False).astype(bool)


def _running(v: np.ndarray, gid: np.ndarray) -> np.ndarray:
    """Running sums that restart with ``gid``; a NaN or infinity spoils the
    rest of its own group only."""
    finite = np.isfinite(v)
    out = pd.Series(np.where(finite, v, 0.0)).groupby(gid).cumsum().to_numpy().copy()
    if not finite.all():
        by = lambda flag: pd.Series(flag.astype(np.int64)).groupby(gid).cumsum().to_numpy() > 0
        up, down, nan = by(v == np.inf), by(v == -np.inf), by(np.isnan(v))
        out[up] = np.inf
        out[down] = -np.inf
        out[nan | (up & down)] = np.nan
    return out


def _emit(rb, cols, last):
    n = rb.num_rows
    flag = np.zeros(n, dtype=bool)
    if last:
        flag[-1] = True
    arrays = list(rb.columns) + list(cols.values()) + [pa.array(flag, type=pa.bool_())]
    names = list(rb.schema.names) + list(cols.keys()) + [_P + "last"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _arrow_scan(work: DataFrame, sort_keys: list[Column], segment: str | None, sum_names: list[str],
                lag_src: list[str], num_partitions: int | None) -> tuple[DataFrame, list]:
    """Partition-local running values as a written table, and its last rows."""
    # without an explicit count AQE may coalesce the range partitions; it
    # merges neighbours only, so partition ids stay in range order
    ranged = (work.repartitionByRange(*([num_partitions] if num_partitions else []), *sort_keys)
              .sortWithinPartitions(*sort_keys)
              .withColumn(_P + "pid", F.spark_partition_id()))
    fields = list(ranged.schema.fields)
    fields += [T.StructField(_P + "pos", T.LongType()), T.StructField(_P + "first", T.BooleanType()),
               T.StructField(_P + "cnt", T.LongType())]
    fields += [T.StructField(_P + "sum" + str(i), T.DoubleType()) for i in range(len(sum_names))]
    src_types = {f.name: f.dataType for f in ranged.schema.fields}
    fields += [T.StructField(_P + "lag" + str(j), src_types[c]) for j, c in enumerate(lag_src)]
    fields += [T.StructField(_P + "last", T.BooleanType())]
    local = ranged.mapInArrow(_local_scan(segment, sum_names, lag_src), T.StructType(fields))
    local = materialize(local)

    # one row per non-empty partition: its last row
    keep = [_P + "pid", _P + "first", _P + "cnt", _P + "pos"] + [_P + "sum" + str(i) for i in range(len(sum_names))]
    keep += dict.fromkeys(([segment] if segment else []) + lag_src)
    tails = []
    for r in sorted(local.filter(F.col(_P + "last")).select(*keep).collect(), key=lambda r: r[0]):
        tails.append({**r.asDict(recursive=False), _P + "last": [r[c] for c in lag_src]})
    return local, tails


def ordered_scan(df: DataFrame, order: list, *, segment: str | None = None,
                 sums: Mapping[str, Column] | None = None,
                 count: str | None = None,
                 lags: Mapping[str, str] | None = None,
                 index: str | None = None,
                 totals: dict | None = None,
                 num_partitions: int | None = None,
                 strategy: str = "auto",
                 window_max_rows: int = WINDOW_MAX_ROWS,
                 largest: int | None = None) -> DataFrame:
    """Add running values over ``order`` (a total order; include a
    tie-break), restarting at each ``segment`` value when one is given.

    sums   output name -> Column; running sum from the first row up to and
           including the current one (NULL inputs count as 0)
    count  output name of the running row count (1-based)
    lags   output name -> input column; value on the previous row of the
           same segment (NULL on the first)
    index  output name of the global 1-based position in (segment, order),
           not restarted per segment
    totals a dict to receive ``rows`` (row count) and, without a segment,
           the grand total of every sum - taken from the partition tails, so
           callers need no extra pass for them
    strategy  ``auto``: with a segment, one aggregate job measures the
           largest segment; when it is at most ``window_max_rows`` rows an
           ordinary per-segment window is used (every group fits a task),
           otherwise the range-partitioned scan, by ranges where the input allows
           it. ``ranges``/``scan`` (the Arrow pass)/``window`` force one.
    largest  rows of the largest segment, if the caller has measured it
    """
    spark = df.sparkSession
    sums = dict(sums or {})
    lags = dict(lags or {})
    if segment is not None and index is None and strategy not in ("scan", "ranges"):
        largest, rows = (largest, None) if largest is not None and totals is None else largest_segment(df, segment)
        if strategy == "window" or largest <= window_max_rows:
            if totals is not None:
                totals["rows"] = rows
            return _window_scan(df, order, segment, sums, count, lags)
    ensure_checkpoint_dir(spark)

    sum_names = [_P + "in" + str(i) for i in range(len(sums))]
    work = df.withColumns({nm: e.cast("double") for nm, e in zip(sum_names, sums.values())}) if sums else df
    sort_keys = ([F.col(segment).asc()] if segment else []) + [_as_sort(o) for o in order]
    lag_src = list(lags.values())
    src_types = {f.name: f.dataType for f in work.schema.fields}
    ranged = None
    if strategy == "ranges" or (strategy == "auto" and recomputable(df)):
        ranged = _range_scan(work, order, segment, sum_names, lag_src, index is not None, totals is not None, num_partitions)
        if ranged is None and strategy == "ranges":
            raise ValueError("ranges need names or keys of plain types as the order")
    local, tails = ranged or _arrow_scan(work, sort_keys, segment, sum_names, lag_src, num_partitions)

    carry_rows = []
    c_seg, c_cnt, c_sums, c_last, have = None, 0, [0.0] * len(sums), [None] * len(lag_src), False
    c_rows = 0
    for r in tails:
        if have:
            carry_rows.append((r[_P + "pid"], c_rows, c_seg, c_cnt, *c_sums, *c_last))
        c_rows += int(r[_P + "pos"]) + 1
        seg_val = r[segment] if segment else None
        single = bool(r[_P + "first"])
        if have and single and (seg_val == c_seg or (seg_val != seg_val and c_seg != c_seg)):
            c_cnt += int(r[_P + "cnt"])
            c_sums = [a + float(r[_P + "sum" + str(i)]) for i, a in enumerate(c_sums)]
        else:
            c_cnt = int(r[_P + "cnt"])
            c_sums = [float(r[_P + "sum" + str(i)]) for i in range(len(sums))]
        c_seg = seg_val
        c_last = r[_P + "last"]
        have = True

    if totals is not None:
        totals["rows"] = c_rows
        if not segment:
            for i, nm in enumerate(sums):
                totals[nm] = sum(float(r[_P + "sum" + str(i)]) for r in tails)
    seg_type = src_types[segment] if segment else T.StringType()
    cfields = [T.StructField(_P + "pid", T.IntegerType()), T.StructField(_P + "crows", T.LongType()),
               T.StructField(_P + "cseg", seg_type),
               T.StructField(_P + "ccnt", T.LongType())]
    cfields += [T.StructField(_P + "csum" + str(i), T.DoubleType()) for i in range(len(sums))]
    cfields += [T.StructField(_P + "clag" + str(j), src_types[c]) for j, c in enumerate(lag_src)]
    carries = spark.createDataFrame(carry_rows, T.StructType(cfields))
    joined = local.join(F.broadcast(carries), on=_P + "pid", how="left")

    has = F.col(_P + "ccnt").isNotNull()
    cont = has & F.col(_P + "first")
    if segment:
        cont = cont & F.col(segment).eqNullSafe(F.col(_P + "cseg"))
    outs = {}
    if index:
        outs[index] = F.col(_P + "pos") + F.lit(1) + F.coalesce(F.col(_P + "crows"), F.lit(0))
    if count:
        outs[count] = F.col(_P + "cnt") + F.when(cont, F.col(_P + "ccnt")).otherwise(F.lit(0))
    for i, nm in enumerate(sums):
        outs[nm] = F.col(_P + "sum" + str(i)) + F.when(cont, F.col(_P + "csum" + str(i))).otherwise(F.lit(0.0))
    for j, nm in enumerate(lags):
        outs[nm] = F.when(cont & (F.col(_P + "cnt") == 1), F.col(_P + "clag" + str(j))) \
                    .otherwise(F.col(_P + "lag" + str(j)))
    result = joined.withColumns(outs)
    return result.drop(*[c for c in result.columns if c.startswith(_P)])


def row_index(df: DataFrame, order: list, name: str = "index", start: int = 1,
              segment: str | None = None) -> DataFrame:
    """Global (or per-segment) row number in ``order``, starting at ``start``."""
    out = ordered_scan(df, order, segment=segment, count="__rowidx")
    return out.withColumn(name, F.col("__rowidx") + F.lit(start - 1)).drop("__rowidx")


def running_sum(df: DataFrame, value, order: list, name: str,
                segment: str | None = None) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return ordered_scan(df, order, segment=segment, sums={name: v})
