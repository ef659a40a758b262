"""Splits that never divide an entity, and stratified folds (SP1-SP4).

None of them sorts the table into one task: positions come from the
distributed scan, over the row table or over the one-row-per-key table.
The only driver work is a handful of look-ups (row counts, the keys near
chunk boundaries).
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import col
from .ranges import ROWS_PER_RANGE, Key
from .scan import ordered_scan


# keys that one look-up of chunk boundaries brings to the driver at most
KEYS_AT_ONCE = 1_000_000
# rows of a class that one task may take: classes are few and their rows wide
CLASS_ROWS = ROWS_PER_RANGE


def permutation_key(columns: list[str], seed: int = 1) -> Column:
    """Default shuffle order: a seeded 64-bit hash of the given columns."""
    return F.xxhash64(F.lit(seed), *[col(c) for c in columns])


def train_test_split(df: DataFrame, train_fraction: float = 0.75, order: Column | None = None,
                     tiebreak: list[str] | None = None, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """SP1: a seeded permutation of the rows; the first ``int(f * n)`` rows
    are train, the rest test (exact sizes). ``order`` is the permutation key
    (default: hash of ``tiebreak`` or all columns)."""
    parts = split_labels(df, train_fraction, order, tiebreak, seed)
    return (parts.where(F.col("__train")).drop("__train"),
            parts.where(~F.col("__train")).drop("__train"))


def split_labels(df: DataFrame, train_fraction: float = 0.75, order: Column | None = None,
                 tiebreak: list[str] | None = None, seed: int = 1, name: str = "__train") -> DataFrame:
    tb = tiebreak or df.columns
    key = order if order is not None else permutation_key(tb, seed)
    tot: dict = {}
    scanned = ordered_scan(df.withColumn("__perm", key), [Key(F.col("__perm")), *[Key(col(c)) for c in tb]],
                           count="__pos", totals=tot)
    cut = int(train_fraction * tot["rows"])
    return scanned.withColumn(name, F.col("__pos") <= F.lit(cut)).drop("__perm", "__pos")


def key_starts(df: DataFrame, key: str, totals: dict | None = None) -> DataFrame:
    """One row per key (in key order): count, start and end row (0-based,
    inclusive) of the key in a table sorted by key. ``totals["__cum"]``
    receives the table's row count."""
    counts = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("__cnt"))
    scanned = ordered_scan(counts, [Key(col(key))], sums={"__cum": F.col("__cnt")}, totals=totals)
    cum = F.col("__cum").cast("long")
    return scanned.select(col(key), F.col("__cnt").alias("count"),
                          (cum - F.col("__cnt")).alias("start"), (cum - F.lit(1)).alias("end"))


def boundary_split(df: DataFrame, key: str, train_fraction: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """SP2: cut a key-sorted table at the first key start at or after row
    ``int(f * n)``; a key is never divided (the holdout may be empty)."""
    flagged = boundary_labels(df, key, train_fraction)
    return (flagged.where(F.col("__train")).drop("__train"),
            flagged.where(~F.col("__train")).drop("__train"))


def boundary_labels(df: DataFrame, key: str, train_fraction: float = 0.75,
                    name: str = "__train") -> DataFrame:
    """The cut is one key, found in the one-row-per-key table; every row is
    labelled by comparing its key with it, without a join. NULL keys sort first."""
    tot: dict = {}
    starts = key_starts(df, key, tot)
    cut = int(train_fraction * int(tot.get("__cum") or 0))
    first = _first_key(starts, key, F.col("start") >= cut)
    if cut <= 0:
        return df.withColumn(name, F.lit(False))
    return df.withColumn(name, _before(key, first))


def _first_key(starts: DataFrame, key: str, condition: Column):
    """(key, start) of the first key in order that meets ``condition``, or None."""
    r = starts.where(condition).agg(F.min(F.struct(F.col("start").alias("s"), col(key).alias("k"))).alias("m")).first()["m"]
    return None if r is None else (r["k"], int(r["s"]))


def _before(key: str, bound) -> Column:
    """Whether a row's key is below the bound's; NULL keys are below all others."""
    return F.lit(True) if bound is None else F.coalesce(col(key) < F.lit(bound[0]), F.lit(True))


def chunk_bounds(starts: DataFrame, key: str, n_rows: int, n: int, at_once: int = KEYS_AT_ONCE) -> list[tuple]:
    """(first key, first row) of every chunk but the first. From row p a
    chunk runs to the end of the key that holds row ``p + n_rows // n``: the next
    one begins with the first key that starts later.

    That is between 1 and ``largest`` (rows of the largest key) rows after
    row ``p + step``, so the j-th chunk from p begins in a window that grows by
    ``largest`` rows with every j. One job fetches the keys that start in the next windows,
    about ``at_once`` of them at most, and the chain is followed among them. With keys of 1
    to 13 rows that is one job for up to some 1,000 chunks, whatever the table's size.
    Where one window alone has more keys (a key with a large share of the
    rows), its chunk is looked up by a minimum."""
    sizes = starts.agg(F.max("count").alias("largest"), F.count(F.lit(1)).alias("keys")).first()
    largest, keys = int(sizes["largest"] or 1), max(1, int(sizes["keys"]))
    step, p, bounds = n_rows // n, 0, []
    wide = step + largest
    most = max(1, math.isqrt(2 * at_once * n_rows // (keys * largest)))  # j windows hold about j * j * largest / 2 rows
    while True:
        d = F.col("start") - F.lit(p)
        in_window = F.floor((d + F.lit(wide - 1)) / F.lit(wide)) <= F.floor(d / F.lit(step + 1))
        near = starts.where((d > step) & (d <= most * wide) & in_window).select("start", col(key)).limit(at_once + 1).collect()
        if len(near) > at_once:
            if most > 1:
                most //= 2
                continue
            found = [_first_key(starts, key, F.col("start") > p + step)]
        else:
            near = sorted((int(r[0]), i) for i, r in enumerate(near)), near
            rows, at, found = [x for x, _ in near[0]], p, []
            while len(found) < most:
                i = bisect.bisect_right(rows, at + step)
                if i == len(rows):
                    found.append(None)
                    break
                at = rows[i]
                found.append((near[1][near[0][i][1]][1], at))
        bounds += [f for f in found if f is not None]
        if not found or found[-1] is None:
            return bounds
        p = found[-1][1]


def chunk_labels(df: DataFrame, key: str, n: int = 5, name: str = "chunk") -> DataFrame:
    """SP3: label every row with its chunk number (0-based), by comparing its
    key with the chunks' first keys."""
    tot: dict = {}
    starts = key_starts(df, key, tot)
    bounds = chunk_bounds(starts, key, int(tot.get("__cum") or 0), n)
    if len(bounds) > 16:  # one comparison a bound, but no deep expression
        firsts = F.array(*[F.lit(b[0]) for b in bounds])
        chunk = F.size(F.filter(firsts, lambda first: first <= col(key)))
    else:
        chunk = sum((F.when(_before(key, b), F.lit(0)).otherwise(F.lit(1)) for b in bounds), F.lit(0))
    return df.withColumn(name, chunk.cast("int"))


def stratified_folds(df: DataFrame, label: str, order: list[str], k: int = 5, name: str = "fold") -> DataFrame:
    """SP4: the folds of a non-shuffled stratified k-fold split: classes are
    numbered by first appearance in ``order``, the sorted class list is dealt
    round-robin to the folds, and each class's rows (in ``order``) fill its
    folds in contiguous blocks.

    Work: one aggregate per class, a scan of the classes for their place in
    the sorted list and a segmented scan of the rows for their place in their class.
    Rows meet their class in an ordinary join, so any number of classes
    works; a NULL label is a class."""
    first = F.struct(*[col(o) for o in order])
    classes = df.groupBy(col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__N"), F.min(first).alias("__first"))
    classes = ordered_scan(classes, [F.col("__first")], sums={"__end": F.col("__N")})
    classes = classes.select("__label", (F.col("__end").cast("long") - F.col("__N")).alias("__S"), "__N")
    scanned = ordered_scan(df, [Key(col(o)) for o in order], segment=label, count="__r", window_max_rows=CLASS_ROWS)
    scanned = scanned.join(classes, col(label).eqNullSafe(F.col("__label")), "left")
    r0 = F.col("__r") - F.lit(1)

    def dealt(m: Column, fold: int) -> Column:
        # cards a fold has after m were dealt
        return F.floor((m + F.lit(k - 1 - fold)) / F.lit(k))

    fold, upto = F.lit(0), F.lit(0)
    for f in range(k - 1):
        upto = upto + dealt(F.col("__S") + F.col("__N"), f) - dealt(F.col("__S"), f)
        fold = fold + F.when(r0 >= upto, F.lit(1)).otherwise(F.lit(0))
    return scanned.withColumn(name, fold.cast("int")).drop("__r", "__S", "__N", "__label")


def write_boundary_split(df: DataFrame, key: str, path: str, train_fraction: float = 0.75,
                         part: str = "part") -> None:
    """SP2 + IO3: write both sides of the boundary split in one pass, as
    ``{path}/part=train`` and ``{path}/part=holdout``."""
    flagged = boundary_labels(df, key, train_fraction)
    out = flagged.withColumn(part, F.when(F.col("__train"), F.lit("train")).otherwise(F.lit("holdout")))
    out.drop("__train").write.mode("overwrite").partitionBy(part).parquet(path)


def read_split(spark, path: str, which: str = "train", part: str = "part") -> DataFrame:
    """IO5: one side of a written split; the filter on the partition column
    prunes the other side's files."""
    return spark.read.parquet(path).where(F.col(part) == F.lit(which)).drop(part)
