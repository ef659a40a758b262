"""PL1: the panel feature build - many dated statements per key in, one
wide feature row per key out.

The statement table is read twice, with pruned columns:
* statistics: partial aggregate -> exchange on key -> final aggregate;
* statements: partial top-(``periods`` + 2) limit per key -> exchange on key
  -> window limit -> lag windows. The result, at most ``periods`` + 2 rows per
  key, is written once to the scratch folder; the encoder is fitted from it
  and the pivot reads it, so neither repeats the windows.

Category codes are applied to that long panel, before the pivot, in one way
for the wide and the array form and for fitted and loaded mappings.

Deviations from the reference, all deliberate:
* the two statements before the first period are ranked (0, -1) and feed the
  lags of period 1 and the lags of its day gap; earlier ones are not needed by
  any feature. All statements count in the statistics and in ``total_number``;
* the key x rank padding grid is not materialised: padding only adds rows
  before the first real one, so lags on real rows are unchanged and the
  pivot yields the same NULLs. ``diff_rank``/``ratio_rank`` - the only lag
  columns that see the padding - are emitted as the values the padded grid
  gives; ``filter_fill_null`` also fills the periods that a key lacks;
* NaN inputs become NULL before the statistics (Spark orders NaN above all
  numbers, which would change min/max).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.calendar import cast_dates, days_between
from ..operators.clean import filter_features, narrow_doubles, nans_to_nulls
from ..operators.encode import (_long_values, apply_mapping, apply_mapping_by_rank, codes_from_distinct, load_mapping,
                                save_mapping)
from ..operators.lags import diff_ratio, pairwise_gaps
from ..operators.pivot import pivot_periods, pivot_to_array
from ..operators.ranks import latest_periods
from ..operators.scan import materialize
from ..operators.stats import key_stats
from ..spec import (COUNT_COLUMN, DEFAULT_BALANCE_COLUMNS, DEFAULT_PAYMENT_COLUMNS, RANK_COLUMN, SIGNED_INT_TYPES,
                    PanelSpec, categorical_columns, col, dtype_columns, q)


def build_features(df: DataFrame, spec: PanelSpec = PanelSpec(), target: DataFrame | None = None, *,
                   add_stats: bool = True, add_diff_dates: bool = True, add_diffs: bool = True,
                   add_after_pay: bool = True, balance=DEFAULT_BALANCE_COLUMNS,
                   payment=DEFAULT_PAYMENT_COLUMNS, run_filter: bool = True,
                   filter_fill_null: bool = False, legacy_name_filter: bool = False,
                   drop_first: bool = False, cast_f32: bool = True, encode: bool = True,
                   mapping: DataFrame | None = None, save_mapping_to: str | None = None,
                   handle_unknown_encodings: bool = False, drop_key: bool = True,
                   return_mapping: bool = False, as_array: bool = False):
    """Build the wide feature table (one row per key). Flags mirror the
    reference's ``run``; ``target`` is a table (key, label columns) joined
    with a left join. With ``return_mapping`` the encoder mapping is
    returned too: ``(features, mapping)``. With ``as_array`` the pivoted
    features come as one ``array<float>`` column ``features`` (names in
    ``build_features.feature_names`` order: see ``pivot.pivot_to_array``);
    statistics and target stay columns."""
    key = spec.key
    const_rank_lags: list[str] = []
    df = nans_to_nulls(df)
    df = cast_dates(df, spec)
    ordered = spec.with_(ts="date")
    feature_cols = [c for c in df.columns if c not in set(spec.order) | set(spec.drop)]

    stats = key_stats(df.select(*[col(c) for c in feature_cols]), key, spec.categorical,
                      with_count=COUNT_COLUMN)

    # total_number is constant per key: it (and its lags) are derived after
    # the pivot from the statistics' row count, so the statement branch needs
    # no count join before its windows; a NULL placeholder keeps the column
    # order of the reference
    panel = latest_periods(df.drop(*spec.drop), ordered, with_count=False, before=2).drop(*spec.order)
    panel = panel.withColumn(COUNT_COLUMN, F.lit(None).cast("int"))
    w_order = [RANK_COLUMN]
    if add_diff_dates:
        panel = days_between(panel, key, w_order)
    else:
        panel = panel.drop("date")
    if add_after_pay:
        bal = [b for b in balance if b in panel.columns]
        pay = [p for p in payment if p in panel.columns]
        panel = pairwise_gaps(panel, bal, pay)
    if add_diffs:
        panel = diff_ratio(panel, key, w_order, categorical=[c for c in spec.categorical if c in panel.columns],
                           ieee=not run_filter, strategy="window")
        # lags of the rank itself are the same for every key on the padded
        # grid; they are added as constants after the pivot
        const_rank_lags = [c for c in ("diff_" + RANK_COLUMN, "ratio_" + RANK_COLUMN) if c in panel.columns]
    derived = [c for c in (COUNT_COLUMN, "diff_" + COUNT_COLUMN, "ratio_" + COUNT_COLUMN) if c in panel.columns]
    if run_filter:
        panel = filter_features(panel, legacy_name_filter=legacy_name_filter, fill_null=filter_fill_null,
                                categorical=spec.categorical, order=[key, RANK_COLUMN])
    panel = nans_to_nulls(panel)

    all_values = [c for c in panel.columns if c not in (key, RANK_COLUMN)]
    special = [*const_rank_lags, *derived]
    panel = panel.drop(*special)
    values = [c for c in all_values if c not in special]
    periods = range(1, spec.periods + 1)
    panel = materialize(panel, "panel")
    # the fill covers whole integer columns, so also the periods a key lacks
    fill = run_filter and filter_fill_null
    filled = {c for c in dtype_columns(panel, *SIGNED_INT_TYPES) if c in values} if fill else set()
    filled -= set(categorical_columns(panel, "both", spec.categorical))
    if encode:
        # the wide names the prefix rule picks, and the long columns they come from
        coded = set(categorical_columns([f"{c}_{r}" for c in values for r in periods], "both", spec.categorical))
        long_coded = [c for c in values if any(f"{c}_{r}" in coded for r in periods)]
        also = [] if target is None else [c for c in categorical_columns(target, "both", spec.categorical) if c != key]
        unknown = "missing" if mapping is None or handle_unknown_encodings else "error"
        if mapping is None:
            labels = target.join(stats.select(key), key, "left_semi") if also else None
            mapping = _fit_mapping(panel, long_coded, labels, also, spec.periods)
            if save_mapping_to:
                save_mapping(mapping, save_mapping_to)
                mapping = load_mapping(panel.sparkSession, save_mapping_to)
            elif long_coded or also:
                mapping = materialize(mapping, "mapping")
        panel = apply_mapping_by_rank(panel, mapping, long_coded, RANK_COLUMN, spec.periods, unknown)
    else:
        long_coded, also = [], []
        if as_array and any(kind == "string" for c, kind in panel.dtypes if c in values):
            raise ValueError("as_array needs numeric values: keep encode=True")

    def cell(c: str, r: int, value: str) -> str:
        if c in special:
            return _derived(c, r, spec.periods, const_rank_lags, fill)
        if c in long_coded:
            return f"coalesce({value}, CAST('NaN' AS FLOAT))"
        return f"coalesce({value}, -1)" if c in filled else value

    wide = (pivot_to_array(panel, key, RANK_COLUMN, spec.periods, values)[0] if as_array
            else pivot_periods(panel, key, RANK_COLUMN, spec.periods, values))
    # per-key row count: from the statistics when they are joined anyway
    counted = (stats if add_stats else stats.select(key, COUNT_COLUMN)).withColumnRenamed(key, "__key")
    wide = wide.join(counted, col(key).eqNullSafe(F.col("__key")), "inner").drop("__key")
    rest = [c for c in wide.columns if c not in (key, COUNT_COLUMN, "features") and (as_array or c in counted.columns)]
    keep = [c for c in all_values if not (drop_first and c.startswith(("diff_", "ratio_")))]
    cells = [(c, r) for c in all_values for r in periods if c in keep or r > 1]
    if as_array:
        at = {c: i for i, c in enumerate(values)}
        parts = [f"CAST({cell(c, r, f'features[{at.get(c, 0) * spec.periods + r - 1}]')} AS FLOAT)" for c, r in cells]
        wide = wide.selectExpr(q(key), f"array({', '.join(parts)}) AS features", *[q(c) for c in rest])
        wide = wide.withMetadata("features", {"names": [f"{c}_{r}" for c, r in cells]})
    else:
        wide = wide.selectExpr(q(key), *[f"{cell(c, r, q(f'{c}_{r}'))} AS {q(f'{c}_{r}')}" for c, r in cells],
                               *[q(c) for c in rest])
    if target is not None:
        labels = target.withColumnRenamed(key, "__key")
        wide = wide.join(labels, col(key) == F.col("__key"), "left").drop("__key")
        if also:
            wide = apply_mapping(wide, mapping, also, missing=float("nan"), dtype="float", handle_unknown=unknown)
    if cast_f32:
        wide = narrow_doubles(wide)
    if drop_key:
        wide = wide.drop(key)
    return (wide, mapping) if return_mapping else wide


run = build_features


def feature_names(features: DataFrame) -> list[str]:
    """Names of the elements of an ``as_array`` result's ``features``."""
    return list(features.schema["features"].metadata["names"])


def _derived(c: str, r: int, periods: int, consts: list[str], fill: bool) -> str:
    """A pivoted column that needs no pivot, as SQL over the key's count n:

    * lags of the rank on the padded grid: ``diff_rank_r`` = 1 and
      ``ratio_rank_r`` = r/(r-1) for r >= 2; for r = 1 the difference is 1 if
      there is a statement before the first period, else NULL (the ratio is 1/0);
    * ``total_number_r`` = n for the periods the key has (r > periods - n),
      its difference 0 and ratio 1 where the statement before exists as well."""
    n = q(COUNT_COLUMN)
    first = f"({periods} - {n} + 1)"  # the key's first rank, below 1 for long histories
    if c in consts:
        earlier = f"{first} < 1"
        if c.startswith("diff_"):
            value = "CAST(1 AS FLOAT)" if r > 1 else f"CASE WHEN {earlier} THEN CAST(1 AS FLOAT) END"
        else:
            value = f"CAST({r}.0D / {r - 1}.0D AS DOUBLE)" if r > 1 else "CAST(NULL AS DOUBLE)"
    elif c == COUNT_COLUMN:
        value = f"CASE WHEN {r} >= {first} THEN CAST({n} AS INT) END"
    elif c.startswith("diff_"):
        value = f"CASE WHEN {r} > {first} THEN CAST(0 AS FLOAT) END"
    else:
        value = f"CASE WHEN {r} > {first} THEN CAST(1 AS DOUBLE) END"
    return f"coalesce({value}, -1)" if fill and c == COUNT_COLUMN else value


def _fit_mapping(panel: DataFrame, long_coded: list[str], labels: DataFrame | None, also: list[str],
                 periods: int) -> DataFrame:
    """Sorted-value codes for the wide categorical columns, fitted on the
    long panel: the distinct values of ``{c}_{r}`` are those of ``c`` at rank
    r. Also for the listed label columns."""
    parts = []
    if long_coded:
        lv = _long_values(panel.where(col(RANK_COLUMN).between(1, periods)).select(RANK_COLUMN, *[col(c) for c in long_coded]),
                          long_coded, {"rank": F.col(RANK_COLUMN)})
        parts.append(lv.select(F.concat(F.col("column"), F.lit("_"), F.col("rank").cast("string")).alias("column"), "value", "num"))
    if also:
        parts.append(_long_values(labels, also))
    if not parts:
        return panel.sparkSession.createDataFrame([], "column string, value string, code int")
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return codes_from_distinct(long.where(F.col("value").isNotNull()).distinct(), "sorted")

