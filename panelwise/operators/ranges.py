"""Rows dealt into ranges of a sort order by bounds that the plan itself holds.

``repartitionByRange`` draws its bounds anew in every job, so rows that are
used twice have to be written in between. Here the bounds come from one small
sample and become constants of an expression: the range of a row follows from
its own values, in every job and after the loss of an executor, and a narrow
aggregate and a wide projection agree on it without a table between them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# rows that are not worth splitting, and sampled rows for a range (at most
# some 20 times the shuffle partitions reach the driver)
ROWS_PER_RANGE = 100_000
SAMPLES_PER_RANGE = 20


@dataclass(frozen=True)
class Key:
    """A sort key that shows its direction: ascending with NULL first or
    descending with NULL last, as Spark's defaults (a plain ``Column`` hides it)."""
    column: Column
    descending: bool = False

    def sort(self) -> Column:
        return self.column.desc() if self.descending else self.column.asc()


def as_keys(order: list) -> list[Key] | None:
    """Names and keys as keys; None if a plain column is among them."""
    keys = [Key(F.col(o)) if isinstance(o, str) else o for o in order]
    return keys if all(isinstance(k, Key) for k in keys) else None


def _fields(c: Column, kind: T.DataType, descending: bool) -> list[tuple[Column, T.DataType]] | None:
    """(flag, value), never NULL, that compare ascending as the key sorts; None if its type has no such form."""
    if kind == T.TimestampType():
        c, kind = F.unix_micros(c), T.LongType()
    elif kind == T.DateType():
        c, kind = F.unix_date(c), T.IntegerType()
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    real = isinstance(kind, (T.FloatType, T.DoubleType))
    if not descending:
        if not (whole or real or isinstance(kind, (T.DecimalType, T.BooleanType, T.TimestampNTZType)) or kind == T.StringType()):
            return None
        return [(F.when(c.isNull(), F.lit(0)).otherwise(F.lit(1)), T.IntegerType()), (_filled(c, kind), kind)]
    flag = F.when(c.isNull(), F.lit(2)).otherwise(F.lit(1))
    if whole:
        c = F.bitwise_not(c)  # the negative would overflow at the least number
    elif real:
        flag = F.when(c.isNull(), F.lit(2)).when(F.isnan(c), F.lit(0)).otherwise(F.lit(1))
        c = -c
    elif isinstance(kind, T.DecimalType):
        c = -c
    elif isinstance(kind, T.BooleanType):
        c = ~c
    else:
        return None
    return [(flag, T.IntegerType()), (_filled(c, kind), kind)]


def _filled(c: Column, kind: T.DataType) -> Column:
    some = "" if kind == T.StringType() else "1970-01-01" if isinstance(kind, T.TimestampNTZType) else "0"
    return F.coalesce(c, F.lit(some).cast(kind))


def comparable(df: DataFrame, keys: list[Key]) -> list[tuple[Column, T.DataType]] | None:
    """Columns that, as a struct, compare as rows sort by ``keys``; None if a
    key's type has no such form (text or wall-clock times descending, nested and binary values)."""
    kinds = [f.dataType for f in df.select(*[k.column.alias(f"k{i}") for i, k in enumerate(keys)]).schema]
    fields = [_fields(k.column, kind, k.descending) for k, kind in zip(keys, kinds)]
    return None if any(f is None for f in fields) else [x for f in fields for x in f]


def as_struct(fields: list[tuple[Column, T.DataType]]) -> Column:
    return F.struct(*[c.cast(kind).alias(f"f{i}") for i, (c, kind) in enumerate(fields)])


def deal(df: DataFrame, fields: list[tuple[Column, T.DataType]], name: str, n: int | None = None) -> tuple[DataFrame, int]:
    """(df with ``name``, count of ranges): adds the number of a row's range (0-based, ascending in the order of
    ``fields``); rows with equal fields share a range. Without ``n`` there are
    twice as many ranges as shuffle partitions, fewer if they would hold under
    ``ROWS_PER_RANGE`` rows.

    A row finds its range by halving among the bounds, one projection a step,
    so the work per row grows with the logarithm of their count. Only as many
    leading fields are compared as tell the bounds apart: a value that fills
    several ranges is cut by the fields behind it."""
    bounds, m = _bounds(df, fields, n)
    if not bounds:
        return df.withColumn(name, F.lit(0)), 1
    row, held = name + "_row", F.expr("array(" + ", ".join(_constant(b, fields) for b in bounds) + ")")
    out = df.withColumns({row: as_struct(fields[:m]), name: F.lit(0)})
    step = 1 << (len(bounds).bit_length() - 1)
    while step:
        at = F.col(name) + F.lit(step - 1)
        passed = F.coalesce(F.get(held, at) <= F.col(row), F.lit(False))  # no bound there: not passed
        out = out.withColumn(name, F.when(passed, F.col(name) + F.lit(step)).otherwise(F.col(name)))
        step //= 2
    return out.drop(row), len(bounds) + 1


def _constant(bound: tuple, fields: list[tuple[Column, T.DataType]]) -> str:
    """A bound as SQL; in hex, so that no text needs quoting. (One expression
    of text plans faster than some calls to the JVM for every value.)"""
    return "named_struct(" + ", ".join(f"'f{i}', CAST(decode(unhex('{v.encode().hex()}'), 'UTF-8') AS {kind.simpleString()})"
                                       for i, (v, (_, kind)) in enumerate(zip(bound, fields))) + ")"


def _bounds(df: DataFrame, fields: list[tuple[Column, T.DataType]], n: int | None) -> tuple[list[tuple], int]:
    """Ascending bounds between ranges as texts, and how many leading fields they need."""
    narrow = df.select(*[c.cast(kind).alias(f"f{i}") for i, (c, kind) in enumerate(fields)])
    rows = narrow.count()
    if n is None:
        n = min(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))
    if n <= 1 or rows <= 1:
        return [], 0
    if rows > 2 * SAMPLES_PER_RANGE * n:
        narrow = narrow.sample(SAMPLES_PER_RANGE * n / rows, seed=1)
    # the text of a value gives the same value back, floating or not
    sample = [tuple(r) for r in narrow.repartition(1).sortWithinPartitions(*narrow.columns)
              .select(*[F.col(c).cast("string") for c in narrow.columns]).collect()]
    picked = list(dict.fromkeys(sample[i * len(sample) // n] for i in range(1, n))) if sample else []
    m = next((m for m in range(2, len(fields), 2) if len({b[:m] for b in picked}) == len(picked)), len(fields))
    return [b[:m] for b in picked], m


# operators that give a row for a row, or drop it, by the row's own values
_ROW_WISE = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "LocalRelation", "Range", "Union", "View"}


def recomputable(df: DataFrame) -> bool:
    """Whether ``df`` is sure to give the same rows in every job: rows of
    files, ranges or local lists, changed one by one by deterministic
    expressions. Joins, aggregates, limits and RDDs are not looked into."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return False
    todo = [plan.queryExecution().analyzed()]
    if not todo[0].deterministic():
        return False
    while todo:
        node = todo.pop()
        if node.nodeName() not in _ROW_WISE:
            return False
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return True
