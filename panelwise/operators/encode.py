"""Category encoders (EN1-EN5).

Fitting is a distinct over (column, value) in long form - one scan, map-side
combined - followed by a rank inside each column's distinct values, so work
grows with the number of distinct categories, not rows. The mapping is a
small table ``(column, value, code)`` that is saved as Parquet.

Applying a mapping: if its size (counted, an action on the small table) is
within ``max_literal_entries``, each column with at most
``MAX_LITERAL_PER_COLUMN`` entries becomes one literal map inside the
projection - no join at all. Every other column is joined to its own part
of the mapping; Spark's size check then picks broadcast or shuffle per
column, and AQE splits skewed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import hash_or_null
from ..spec import DEFAULT_CATEGORICAL, categorical_columns, col, q, sql_literal

_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
MAX_LITERAL_ENTRIES = 50_000
# A literal map is searched linearly per row (about 10 s per 600k rows at
# 10k entries, 0.4 s at 100), so one column's inlined map stays small;
# larger ones are joined (a hash lookup).
MAX_LITERAL_PER_COLUMN = 512


def _long_values(df: DataFrame, columns: list[str], extra: dict | None = None) -> DataFrame:
    """(column, value string, num double) for every row and column."""
    extra = extra or {}
    structs = []
    for c in columns:
        numeric = isinstance(df.schema[c].dataType, _NUM)
        fields = [col(c).cast("string").alias("value"),
                  (col(c).cast("double") if numeric else F.lit(None).cast("double")).alias("num")]
        fields += [v.alias(k) for k, v in extra.items()]
        structs.append(F.struct(*fields).alias(c))
    wide = df.select(*structs)
    long = wide.unpivot([], columns, "column", "v")
    return long.select("column", "v.*")


def fit_ordinal_encoder(df: DataFrame, columns: list[str]) -> DataFrame:
    """EN1 fit: per column, the sorted distinct non-null values get codes
    0..k-1. Numbers sort as numbers (2 before 10), text as text."""
    long = _long_values(df, columns).where(F.col("value").isNotNull()).distinct()
    return codes_from_distinct(long, "sorted")


def first_seen_mapping(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """EN2 fit: codes in order of first appearance under ``order``."""
    if not order:
        raise ValueError("first-seen codes need an order (the row order that defines first)")
    first = F.struct(*[col(o) for o in order])
    long = _long_values(df, columns, {"pos": first}).where(F.col("value").isNotNull())
    firsts = long.groupBy("column", "value").agg(F.min("pos").alias("pos"))
    return codes_from_distinct(firsts, "first")


def codes_from_distinct(distinct: DataFrame, rule: str, max_rows: int = MAX_LITERAL_ENTRIES) -> DataFrame:
    """Codes 0..k-1 per column for a table of distinct (column, value, ...)
    rows: ``sorted`` orders by (num, value), ``first`` by ``pos``.

    Within the literal bound the table is collected (one job) and ranked on
    the driver. Beyond it, the rank is a segmented distributed scan over the
    columns, so no task gathers all values of one column."""
    spark = distinct.sparkSession
    rows = bounded_collect(distinct, max_rows)
    if rows is not None:
        by_col: dict[str, list] = {}
        for r in rows:
            by_col.setdefault(r["column"], []).append(r)
        out = []
        for c, rs in by_col.items():
            rs.sort(key=_sorted_key if rule == "sorted" else _first_key)
            out += [(c, r["value"], i) for i, r in enumerate(rs)]
        return spark.createDataFrame(out, "column string, value string, code int")
    from .scan import ordered_scan
    order = ([F.col("num").asc_nulls_last(), F.col("value")] if rule == "sorted" else [F.col("pos")])
    ranked = ordered_scan(distinct, order, segment="column", count="__code")
    return ranked.select("column", "value", (F.col("__code") - 1).cast("int").alias("code"))


def _sorted_key(r):
    n = r["num"]
    # Spark's ascending order: numbers (NaN above all of them), then NULL; ties by text
    return (n is None, n is not None and n != n, n if n is not None and n == n else 0.0, r["value"])


def _first_key(r):
    # struct order with NULL first, as Spark's ascending min over structs
    return tuple((x is not None, x) for x in r["pos"])


def apply_mapping(df: DataFrame, mapping: DataFrame, columns: list[str], *,
                  missing=float("nan"), dtype: str = "float", handle_unknown: str = "missing",
                  max_literal_entries: int = MAX_LITERAL_ENTRIES) -> DataFrame:
    """Replace each listed column by its code. NULL -> ``missing``; a value
    absent from the mapping -> ``missing`` (``handle_unknown="missing"``)
    or a runtime error (``"error"``)."""
    if not columns:
        return df
    mapping = mapping.where(F.col("column").isin(list(columns)))
    rows = bounded_collect(mapping, max_literal_entries)
    miss = F.lit(missing).cast(dtype)
    if rows is not None:
        per_col: dict[str, list] = {c: [] for c in columns}
        for r in rows:
            per_col[r["column"]].append((r["value"], r["code"]))
        todo = {c for c in columns if len(per_col[c]) <= MAX_LITERAL_PER_COLUMN}
        exprs = []
        for c in df.columns:
            if c not in todo:
                exprs.append(q(c))
                continue
            v = f"CAST({q(c)} AS STRING)"
            code = (f"try_element_at({_map_sql(per_col[c])}, {v})" if per_col[c] else "CAST(NULL AS INT)")
            exprs.append(f"{_finish_sql(v, code, missing, dtype, handle_unknown, c)} AS {q(c)}")
        df = df.selectExpr(*exprs)
        columns = [c for c in columns if c not in todo]
    out = df
    for i, c in enumerate(columns):
        part = mapping.where(F.col("column") == c).select(
            F.col("value").alias(f"__v{i}"), F.col("code").alias(f"__c{i}"))
        out = out.join(part, col(c).cast("string") == F.col(f"__v{i}"), "left")
        out = out.withColumn(c, _finish(col(c), F.col(f"__c{i}"), miss, dtype, handle_unknown, c)) \
                 .drop(f"__v{i}", f"__c{i}")
    return out


def bounded_collect(df: DataFrame, max_rows: int):
    """The rows of a small table, or None when it has more than
    ``max_rows`` (one job either way; at most ``max_rows + 1`` rows move)."""
    rows = df.limit(max_rows + 1).collect()
    return None if len(rows) > max_rows else rows


def apply_mapping_by_rank(df: DataFrame, mapping: DataFrame, columns: list[str], rank: str, periods: int,
                          handle_unknown: str = "missing", literal: int = MAX_LITERAL_PER_COLUMN) -> DataFrame:
    """Apply a mapping fitted on pivoted names ``{c}_{r}`` to the long table
    before the pivot: the code of ``c`` depends on its rank. NULL gives NULL
    here, and so does an unseen value unless ``handle_unknown="error"``.

    A (column, rank) with at most ``literal`` codes becomes a literal map; the
    codes of larger ones are joined by (rank, value), one join a column. Both ways give the
    same codes; which one is taken depends on the counts of codes, a bounded
    table of columns x periods."""
    spark = df.sparkSession
    wide = [(f"{c}_{r}", c, r) for c in columns for r in range(1, periods + 1)]
    names = spark.createDataFrame(wide, "column string, __name string, __rank int")
    codes = mapping.join(F.broadcast(names), "column")  # columns x periods names
    sizes = {(r["__name"], r["__rank"]): r["count"] for r in codes.groupBy("__name", "__rank").count().collect()}
    small = {k for k, n in sizes.items() if n <= literal}
    inlined: dict[tuple, list] = {}
    if small:
        few = spark.createDataFrame(sorted(small), "__name string, __rank int")
        for r in codes.join(F.broadcast(few), ["__name", "__rank"]).collect():
            inlined.setdefault((r["__name"], r["__rank"]), []).append((r["value"], r["code"]))
    joined = [c for c in columns if any(k[0] == c and k not in small for k in sizes)]
    out = df
    for i, c in enumerate(joined):
        part = codes.where(F.col("__name") == c).select(F.col("__rank").alias(f"__r{i}"), F.col("value").alias(f"__v{i}"),
                                                        F.col("code").alias(f"__c{i}"))
        out = out.join(part, (col(rank) == F.col(f"__r{i}")) & (col(c).cast("string") == F.col(f"__v{i}")), "left")
    exprs = []
    for name in df.columns:
        if name not in columns:
            exprs.append(q(name))
            continue
        value = f"CAST({q(name)} AS STRING)"
        if name in joined:
            code = f"__c{joined.index(name)}"
        else:
            arms = [f"WHEN {r} THEN try_element_at({_map_sql(sorted(inlined[(name, r)]))}, {value})"
                    for r in range(1, periods + 1) if (name, r) in inlined]
            code = f"CASE {q(rank)} {' '.join(arms)} END" if arms else "CAST(NULL AS INT)"
        if handle_unknown == "error":
            text = sql_literal(f"unknown category in column {name}")
            code = (f"CASE WHEN {value} IS NOT NULL AND {q(rank)} BETWEEN 1 AND {periods} AND {code} IS NULL "
                    f"THEN CAST(raise_error({text}) AS FLOAT) ELSE {code} END")
        exprs.append(f"CAST({code} AS FLOAT) AS {q(name)}")
    return out.selectExpr(*exprs)


def _map_sql(pairs) -> str:
    """A literal map expression (one SQL string, parsed once on the JVM)."""
    return "map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(int(v))}" for k, v in pairs) + ")"


def _finish_sql(v: str, code: str, missing, dtype: str, handle_unknown: str, name: str) -> str:
    miss = f"CAST({sql_literal(missing)} AS {dtype})"
    if isinstance(missing, float) and missing != missing:
        miss = f"CAST('NaN' AS {dtype})"
    coded = f"CAST({code} AS {dtype})"
    if handle_unknown == "error":
        err = sql_literal(f"unknown category in column {name}")
        return (f"CASE WHEN {v} IS NULL THEN {miss} WHEN {code} IS NULL THEN CAST(raise_error({err}) AS {dtype}) "
                f"ELSE {coded} END")
    return f"CASE WHEN {code} IS NULL THEN {miss} ELSE {coded} END"


def _finish(v, code, miss, dtype, handle_unknown, name):
    coded = code.cast(dtype)
    if handle_unknown == "error":
        unknown = F.raise_error(F.lit(f"unknown category in column {name}"))
        return F.when(v.isNull(), miss).when(code.isNull(), unknown).otherwise(coded)
    return F.when(code.isNull(), miss).otherwise(coded)


def save_mapping(mapping: DataFrame, path: str) -> None:
    mapping.write.mode("overwrite").parquet(path)


def load_mapping(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ordinal_encode(df: DataFrame, columns: list[str] | None = None, *, mapping: DataFrame | None = None,
                   save_to: str | None = None, handle_unknown: bool = False,
                   missing=float("nan"), dtype: str = "float",
                   categorical=DEFAULT_CATEGORICAL) -> tuple[DataFrame, DataFrame]:
    """EN1 (``sklearn_encoder``): categorical columns (prefix rule) -> sorted
    value codes as float, NULL -> NaN. Pass ``mapping`` to reuse a saved
    one (unknown values raise unless ``handle_unknown``). Returns
    (encoded table, mapping)."""
    if columns is None:
        columns = categorical_columns(df, "both", categorical)
    if mapping is None:
        mapping = fit_ordinal_encoder(df, columns)
        if save_to:
            save_mapping(mapping, save_to)
            mapping = load_mapping(df.sparkSession, save_to)
    out = apply_mapping(df, mapping, columns, missing=missing, dtype=dtype,
                        handle_unknown="missing" if handle_unknown else "error")
    return out, mapping


def encode_categoricals(df: DataFrame, columns: list[str] | None = None, *,
                        mapping: DataFrame | None = None,
                        categorical=DEFAULT_CATEGORICAL) -> tuple[DataFrame, DataFrame]:
    """EN3: ordinal int codes with -1 for missing; a loaded mapping is used
    as it is (not re-fitted)."""
    return ordinal_encode(df, columns, mapping=mapping, handle_unknown=True,
                          missing=-1, dtype="int", categorical=categorical)


def first_seen_encode(df: DataFrame, columns: list[str], order: list[str], dtype: str = "int") -> DataFrame:
    """EN2: dictionary codes in first-seen order (NULL stays NULL)."""
    mapping = first_seen_mapping(df, columns, order)
    return apply_mapping(df, mapping, columns, missing=None, dtype=dtype, handle_unknown="missing")


def hash_columns(df: DataFrame, columns: list[str] | None = None,
                 categorical=DEFAULT_CATEGORICAL) -> DataFrame:
    """EN4: categorical columns -> 64-bit hash, NULL stays NULL."""
    if columns is None:
        columns = categorical_columns(df, "both", categorical)
    return df.withColumns({c: hash_or_null(col(c)) for c in columns})
