"""Registered queries: each operator of the blueprint run on the generated
test tables, plus the equivalent DuckDB SQL used as the correctness oracle.

Every query reads whole tables. Floating values whose last bits depend on
summation order or on the math library (sums, variances, running shares,
exp/log) are returned as ``float`` on both sides, so both engines round the
same double to the same single.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import hex_tail_to_uint64, ieee_ratio
from .operators import calendar, clean, cumulative, encode, lags, metric, pivot, ranks, split, stats
from .operators.scan import largest_segment, ordered_scan
from .plans.features import build_features
from .sources import io
from .spec import PanelSpec, categorical_columns, col, dtype_columns, regex_columns

ORDERS_SPEC = PanelSpec(key="o_custkey", ts="o_orderdate", order=("o_orderkey",),
                        categorical=("o_orderstatus", "o_orderpriority"))
LINEITEM_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus")
LINEITEM_SPEC = PanelSpec(key="l_orderkey", ts="l_shipdate", order=LINEITEM_ORDER,
                          categorical=("l_returnflag", "l_linestatus"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _f(c):
    return col(c).cast("float") if isinstance(c, str) else c.cast("float")


def _ts_dates(df: DataFrame) -> DataFrame:
    """Present date columns as timestamps (the test tables' own type), so
    both engines hand the oracle the same kind of value."""
    ds = dtype_columns(df, "date")
    return df.withColumns({c: col(c).cast("timestamp_ntz") for c in ds}) if ds else df


# ---------------------------------------------------------------------------
# Calendar, statistics, ranks (PR6, AG1-AG3, RN1, RN2, RN11)
# ---------------------------------------------------------------------------

@query("cast_dates", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "Month",
       CAST(day(d) AS INTEGER) AS "Day", CAST(d AS TIMESTAMP) AS date
FROM (SELECT *, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS d FROM orders)
""")
def q_cast_dates(spark, d):
    o = t(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _ts_dates(calendar.cast_dates(o, ORDERS_SPEC))


@query("key_stats", """
SELECT o_custkey,
       CAST(min(o_totalprice) AS FLOAT) AS min_o_totalprice, CAST(max(o_totalprice) AS FLOAT) AS max_o_totalprice,
       CAST(stddev_samp(o_totalprice) AS FLOAT) AS std_o_totalprice,
       CAST(var_samp(o_totalprice) AS FLOAT) AS var_o_totalprice,
       CAST(sum(o_totalprice) AS FLOAT) AS sum_o_totalprice,
       min(o_orderstatus) AS min_o_orderstatus, min(o_orderpriority) AS min_o_orderpriority,
       max(o_orderstatus) AS max_o_orderstatus, max(o_orderpriority) AS max_o_orderpriority,
       CAST(date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) AS INTEGER)
         AS days_from_first_to_last_payment
FROM orders GROUP BY o_custkey
""")
def q_key_stats(spark, d):
    o = calendar.cast_dates(t(spark, d, "orders"), ORDERS_SPEC).drop("o_orderkey")
    s = stats.key_stats(o, "o_custkey", ORDERS_SPEC.categorical)
    return s.withColumns({c: _f(c) for c in s.columns if c.split("_")[0] in ("min", "max", "std", "var", "sum")
                          and c.endswith("totalprice")})


_RANKED_ORDERS = """
SELECT o_custkey, CAST(14 - rn AS INTEGER) AS rank, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority,
       CAST(year(date) AS INTEGER) AS "Year", CAST(month(date) AS INTEGER) AS "Month",
       CAST(day(date) AS INTEGER) AS "Day", CAST(date AS TIMESTAMP) AS date,
       CAST(total_number AS INTEGER) AS total_number
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY date DESC, o_orderkey DESC) AS rn,
             count(*) OVER (PARTITION BY o_custkey) AS total_number
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS date FROM orders))
"""


@query("add_rank", _RANKED_ORDERS)
def q_add_rank(spark, d):
    o = calendar.cast_dates(t(spark, d, "orders"), ORDERS_SPEC)
    return _ts_dates(ranks.add_rank(o, ORDERS_SPEC.with_(ts="date")))


def _latest_orders(spark, d):
    o = calendar.cast_dates(t(spark, d, "orders"), ORDERS_SPEC)
    return ranks.latest_periods(o, ORDERS_SPEC.with_(ts="date"), with_count=False)


@query("full_ranks", f"""
WITH ranked AS ({_RANKED_ORDERS}),
grid AS (SELECT k.o_custkey, CAST(r.rank AS INTEGER) AS rank
         FROM (SELECT DISTINCT o_custkey FROM orders) k CROSS JOIN range(1, 14) r(rank))
SELECT coalesce(g.o_custkey, x.o_custkey) AS o_custkey, coalesce(g.rank, x.rank) AS rank, x.o_orderkey, x.o_orderstatus, x.o_totalprice, x.o_orderpriority, x."Year",
       x."Month", x."Day", x.date, x.total_number
FROM grid g FULL JOIN ranked x ON g.o_custkey = x.o_custkey AND g.rank = x.rank
""")
def q_full_ranks(spark, d):
    o = calendar.cast_dates(t(spark, d, "orders"), ORDERS_SPEC)
    return _ts_dates(ranks.full_ranks(o, ORDERS_SPEC.with_(ts="date")))


@query("days_between", """
SELECT o_orderkey, o_custkey,
       CAST(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE)) AS INTEGER)
         AS days_since_last_payment
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def q_days_between(spark, d):
    o = calendar.cast_dates(t(spark, d, "orders"), ORDERS_SPEC)
    s = calendar.days_since_previous(o.select("o_orderkey", "o_custkey", "date"), "o_custkey",
                                     ["date", "o_orderkey"])
    return s.select("o_orderkey", "o_custkey", "days_since_last_payment")


@query("distinct_keys", "SELECT DISTINCT o_custkey FROM orders")
def q_distinct_keys(spark, d):
    return stats.distinct_keys(t(spark, d, "orders"), "o_custkey")


# ---------------------------------------------------------------------------
# Lag features (RN6-RN10, PR7-PR10)
# ---------------------------------------------------------------------------

@query("lag_diff", """
SELECT o_orderkey, o_custkey, CAST(o_totalprice - lag(o_totalprice) OVER w AS FLOAT) AS diff_o_totalprice
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def q_lag_diff(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    s = lags.lag_features_scan(o, "o_custkey", ["o_orderdate", "o_orderkey"], numeric=["o_totalprice"])
    return s.select("o_orderkey", "o_custkey", "diff_o_totalprice")


@query("lag_ratio", """
SELECT o_orderkey, o_custkey, o_totalprice / NULLIF(lag(o_totalprice) OVER w, 0) AS ratio_o_totalprice
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def q_lag_ratio(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    s = lags.lag_features_scan(o, "o_custkey", ["o_orderdate", "o_orderkey"], numeric=["o_totalprice"])
    return s.select("o_orderkey", "o_custkey", "ratio_o_totalprice")


def _lineitem_panel(spark, d):
    """The ranked statements and the rows of the largest key, measured once."""
    li = calendar.cast_dates(t(spark, d, "lineitem"), LINEITEM_SPEC)
    largest, _ = largest_segment(t(spark, d, "lineitem"), "l_orderkey")
    return ranks.add_rank(li, LINEITEM_SPEC.with_(ts="date"), largest), largest


_LI_NUMERIC = ("rank", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "total_number")
_LI_ORDER_SQL = ", ".join(f"{c} DESC" for c in LINEITEM_ORDER)
_LI_PANEL = f"""
SELECT l_orderkey, CAST(14 - rn AS INTEGER) AS rank, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       CAST(year(date) AS INTEGER) AS "Year", CAST(month(date) AS INTEGER) AS "Month",
       CAST(day(date) AS INTEGER) AS "Day", CAST(date AS TIMESTAMP) AS date,
       CAST(total_number AS INTEGER) AS total_number
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY date DESC, {_LI_ORDER_SQL}) AS rn,
             count(*) OVER (PARTITION BY l_orderkey) AS total_number
      FROM (SELECT *, CAST(l_shipdate AS DATE) AS date FROM lineitem))
"""


def _diff_ratio_sql(f32: bool) -> str:
    diffs = [f"CAST({c} - lag({c}) OVER w AS FLOAT) AS diff_{c}" for c in _LI_NUMERIC]
    if f32:
        ratios = [f"CAST(CAST({c} AS FLOAT) / NULLIF(CAST(lag({c}) OVER w AS FLOAT), 0) AS FLOAT) AS ratio_{c}"
                  for c in _LI_NUMERIC]
    else:
        ratios = [f"CAST({c} AS DOUBLE) / NULLIF(CAST(lag({c}) OVER w AS DOUBLE), 0) AS ratio_{c}"
                  for c in _LI_NUMERIC]
    trans = [f"{c} || '->' || lag({c}) OVER w AS diff_cat_{c}" for c in ("l_returnflag", "l_linestatus")]
    return (f"WITH p AS ({_LI_PANEL}) SELECT *, " + ", ".join(diffs + ratios + trans)
            + " FROM p WINDOW w AS (PARTITION BY l_orderkey ORDER BY rank)")


@query("diff_ratio", _diff_ratio_sql(False))
def q_diff_ratio(spark, d):
    p, largest = _lineitem_panel(spark, d)
    return _ts_dates(lags.diff_ratio(p, "l_orderkey", ["rank"], categorical=LINEITEM_SPEC.categorical, largest=largest))


@query("diff_ratio_f32", _diff_ratio_sql(True))
def q_diff_ratio_f32(spark, d):
    p, largest = _lineitem_panel(spark, d)
    return _ts_dates(lags.diff_ratio(p, "l_orderkey", ["rank"], categorical=LINEITEM_SPEC.categorical,
                                     float32_ratio=True, largest=largest))


@query("diff_ratio_halo", _diff_ratio_sql(False))
def q_diff_ratio_halo(spark, d):
    """RN9 with every key spread over range partitions, as for keys beyond a task."""
    p, _ = _lineitem_panel(spark, d)
    return _ts_dates(lags.diff_ratio(p, "l_orderkey", ["rank"], categorical=LINEITEM_SPEC.categorical, strategy="halo"))


@query("category_transition", """
SELECT event_id, user_id, event_type, event_type || '->' || lag(event_type) OVER w AS diff_cat_event_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def q_category_transition(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    s = lags.lag_features_scan(e, "user_id", ["ts", "event_id"], categorical=["event_type"], numeric=[])
    return s.select("event_id", "user_id", "event_type", "diff_cat_event_type")


@query("transition_fill", """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT event_id, user_id, 14 - rn AS rank, coalesce(event_type || '->' || lag(event_type) OVER w, '') AS diff_cat_event_type
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY rn DESC)
""")
def q_transition_fill(spark, d):
    """RN8 with empty text on each key's first row."""
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    spec = PanelSpec(key="user_id", ts="ts", order=("event_id",), categorical=("event_type",))
    largest, _ = largest_segment(e, "user_id")
    p = ranks.add_rank(e, spec, largest).select("event_id", "user_id", "rank", "event_type")
    out = lags.diff_ratio(p, "user_id", ["rank"], categorical=["event_type"], numeric=[], fill_transitions=True, largest=largest)
    return out.select("event_id", "user_id", F.col("rank").cast("long").alias("rank"), "diff_cat_event_type")


@query("pairwise_gap", """
SELECT l_orderkey, l_linenumber, l_partkey,
       l_extendedprice - l_tax AS "l_extendedprice-l_tax", l_extendedprice - l_discount AS "l_extendedprice-l_discount",
       l_quantity - l_tax AS "l_quantity-l_tax", l_quantity - l_discount AS "l_quantity-l_discount"
FROM lineitem
""")
def q_pairwise_gap(spark, d):
    li = t(spark, d, "lineitem")
    g = lags.pairwise_gaps(li, ("l_extendedprice", "l_quantity"), ("l_tax", "l_discount"))
    return g.select("l_orderkey", "l_linenumber", "l_partkey", *[c for c in g.columns if "-" in c])


_RAW_RATIOS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_discount / lag(l_discount) OVER w AS ratio_l_discount,
       l_tax / lag(l_tax) OVER w AS ratio_l_tax
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey,
                           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)
"""


def _raw_ratios(spark, d):
    li = t(spark, d, "lineitem")
    order = ["l_shipdate", *LINEITEM_ORDER]
    s = ordered_scan(li, order, segment="l_orderkey", lags={"__pd": "l_discount", "__pt": "l_tax"})
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    ieee_ratio(F.col("l_discount"), F.col("__pd")).alias("ratio_l_discount"),
                    ieee_ratio(F.col("l_tax"), F.col("__pt")).alias("ratio_l_tax"))


@query("clean_ratio", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN isinf(ratio_l_discount) OR isnan(ratio_l_discount) THEN NULL ELSE ratio_l_discount END
         AS ratio_l_discount,
       CASE WHEN isinf(ratio_l_tax) OR isnan(ratio_l_tax) THEN NULL ELSE ratio_l_tax END AS ratio_l_tax
FROM ({_RAW_RATIOS})
""")
def q_clean_ratio(spark, d):
    return clean.nans_to_nulls(clean.filter_features(_raw_ratios(spark, d)))


@query("nan_to_null", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN isnan(ratio_l_discount) THEN NULL ELSE ratio_l_discount END AS ratio_l_discount,
       CASE WHEN isnan(ratio_l_tax) THEN NULL ELSE ratio_l_tax END AS ratio_l_tax
FROM ({_RAW_RATIOS})
""")
def q_nan_to_null(spark, d):
    return clean.nans_to_nulls(_raw_ratios(spark, d))


@query("name_filter", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN isinf(ratio_l_tax) OR isnan(ratio_l_tax) THEN NULL ELSE ratio_l_tax END AS ratio_l_tax
FROM ({_RAW_RATIOS})
""")
def q_name_filter(spark, d):
    """PR8 by names: first-period lag columns go, kinds of selectors agree."""
    r = _raw_ratios(spark, d)
    r = r.withColumn("diff_x_1", F.col("ratio_l_tax")).withColumnRenamed("ratio_l_discount", "ratio_l_discount_1")
    out = clean.nans_to_nulls(clean.filter_features(r, legacy_name_filter=True))
    numeric = categorical_columns(out, "numeric", categorical=("l_", "ratio_"))
    return out.select(*numeric, *categorical_columns(out, "string"))


@query("narrow", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN isinf(ratio_l_discount) OR isnan(ratio_l_discount) THEN NULL ELSE ratio_l_discount END
            AS FLOAT) AS ratio_l_discount,
       CAST(CASE WHEN isinf(ratio_l_tax) OR isnan(ratio_l_tax) THEN NULL ELSE ratio_l_tax END AS FLOAT) AS ratio_l_tax
FROM ({_RAW_RATIOS})
""")
def q_narrow(spark, d):
    return clean.narrow_doubles(clean.nans_to_nulls(clean.filter_features(_raw_ratios(spark, d))))


# ---------------------------------------------------------------------------
# Pivot and joins (PV1, PV2, JN1, JN2, JN5, JN6, RN3-RN5, AG4)
# ---------------------------------------------------------------------------

def _pivot_sql(values: list[str], casts: dict[str, str] | None = None) -> str:
    casts = casts or {}
    cols = []
    for c in values:
        for r in range(1, 14):
            e = f"max(CASE WHEN rank = {r} THEN {c} END)"
            if c in casts:
                e = f"CAST({e} AS {casts[c]})"
            cols.append(f"{e} AS {c}_{r}")
    return f"SELECT o_custkey, {', '.join(cols)} FROM ranked GROUP BY o_custkey"


@query("pivot_periods", f"WITH ranked AS ({_RANKED_ORDERS}) {_pivot_sql(['o_totalprice', 'o_orderstatus'])}")
def q_pivot_periods(spark, d):
    p = _latest_orders(spark, d)
    return pivot.pivot_periods(p, "o_custkey", "rank", 13, ["o_totalprice", "o_orderstatus"])


@query("pivot_by_slice", f"WITH ranked AS ({_RANKED_ORDERS}) {_pivot_sql(['o_totalprice'])}")
def q_pivot_by_slice(spark, d):
    p = _latest_orders(spark, d)
    return pivot.pivot_by_slice(p, "o_custkey", "rank", 13, ["o_totalprice"])


@query("stats_join", f"""
WITH ranked AS ({_RANKED_ORDERS}), wide AS ({_pivot_sql(['o_totalprice'], {'o_totalprice': 'FLOAT'})}),
s AS (SELECT o_custkey, CAST(min(o_totalprice) AS FLOAT) AS min_o_totalprice,
             CAST(max(o_totalprice) AS FLOAT) AS max_o_totalprice, CAST(sum(o_totalprice) AS FLOAT) AS sum_o_totalprice
      FROM orders GROUP BY o_custkey)
SELECT * FROM wide JOIN s USING (o_custkey)
""")
def q_stats_join(spark, d):
    o = calendar.cast_dates(t(spark, d, "orders"), ORDERS_SPEC)
    wide = pivot.pivot_periods(ranks.latest_periods(o, ORDERS_SPEC.with_(ts="date")), "o_custkey", "rank", 13,
                               ["o_totalprice"])
    s = o.groupBy("o_custkey").agg(F.min("o_totalprice").alias("min_o_totalprice"),
                                   F.max("o_totalprice").alias("max_o_totalprice"),
                                   F.sum("o_totalprice").alias("sum_o_totalprice"))
    return clean.narrow_doubles(wide.join(s, on="o_custkey", how="inner"))


@query("label_join", """
SELECT k.o_custkey, CAST(c.c_mktsegment = 'MACHINERY' AS INTEGER) AS target
FROM (SELECT DISTINCT o_custkey FROM orders) k LEFT JOIN customer c ON k.o_custkey = c.c_custkey
""")
def q_label_join(spark, d):
    keys = stats.distinct_keys(t(spark, d, "orders"), "o_custkey")
    return keys.join(_target(spark, d), on="o_custkey", how="left")


def _target(spark, d):
    c = t(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("o_custkey"),
                    (F.col("c_mktsegment") == "MACHINERY").cast("int").alias("target"))


@query("row_index", "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS \"index\" FROM orders")
def q_row_index(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return ranks.add_index(o, ["o_orderkey"])


@query("index_count", """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS "index",
       count(*) OVER (PARTITION BY o_custkey) AS "count"
FROM orders
""")
def q_index_count(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return ranks.index_and_count(o, "o_custkey", ["o_orderkey"])


@query("index_sum", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(sum(l_linenumber) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "index",
       count(*) OVER (PARTITION BY l_orderkey) AS "count"
FROM lineitem
""")
def q_index_sum(spark, d):
    """RN4 where an index column exists: its running sum."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                        F.col("l_linenumber").cast("long").alias("index"))
    return ranks.index_and_count(li, "l_orderkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                    "l_quantity"]).drop("l_quantity")


@query("rank_df", """
SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS "index", o_custkey,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS rank
FROM orders
""")
def q_rank_df(spark, d):
    return ranks.rank_df(t(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query("rescale_rank", """
SELECT o_custkey, "count",
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - "count" + 13 AS INTEGER)
         AS rank,
       o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS "count" FROM orders)
""")
def q_rescale_rank(spark, d):
    o = t(spark, d, "orders")
    order = ["o_custkey", "o_orderdate", "o_orderkey"]
    indexed = ranks.index_and_count(o, "o_custkey", order)
    rk = ranks.rank_df(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    return ranks.rescale_rank(indexed, rk, key="o_custkey", periods=13)


@query("positional_join", """
SELECT a.o_orderkey, a.o_custkey, b.l_orderkey, b.l_linenumber, b.l_quantity
FROM (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders) a
JOIN (SELECT l_orderkey, l_linenumber, l_quantity,
             row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos
      FROM lineitem) b ON a.pos = b.pos
""")
def q_positional_join(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    j = ranks.positional_join(o, li, ["o_orderkey"],
                              ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    return j.select("o_orderkey", "o_custkey", "l_orderkey", "l_linenumber", "l_quantity")


@query("group_lists", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
         AS position
FROM orders
""")
def q_group_lists(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return ranks.group_positions(o, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# ---------------------------------------------------------------------------
# Encoders (EN1-EN5)
# ---------------------------------------------------------------------------

@query("ordinal_encode", """
SELECT c_custkey,
       CAST(dense_rank() OVER (ORDER BY c_nationkey) - 1 AS FLOAT) AS c_nationkey,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS FLOAT) AS c_mktsegment
FROM customer
""")
def q_ordinal_encode(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    out, _ = encode.ordinal_encode(c, ["c_nationkey", "c_mktsegment"])
    return out


_EVENT_TRANSITIONS = """
SELECT event_id, user_id, ts, event_type || '->' || lag(event_type) OVER w AS diff_cat_event_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
"""


def _event_transitions(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    s = lags.lag_features_scan(e, "user_id", ["ts", "event_id"], categorical=["event_type"], numeric=[])
    return s.select("event_id", "user_id", "ts", "diff_cat_event_type")


@query("encode_missing", f"""
SELECT event_id, CASE WHEN diff_cat_event_type IS NULL THEN -1
                      ELSE CAST(dense_rank() OVER (ORDER BY diff_cat_event_type NULLS LAST) - 1 AS INTEGER) END
                 AS diff_cat_event_type
FROM ({_EVENT_TRANSITIONS})
""")
def q_encode_missing(spark, d):
    out, _ = encode.encode_categoricals(_event_transitions(spark, d), ["diff_cat_event_type"])
    return out.select("event_id", "diff_cat_event_type")


@query("encode_saved", """
WITH m AS (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'),
k AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code FROM m)
SELECT c_custkey, CASE WHEN k.code IS NULL THEN 'NaN'::FLOAT ELSE CAST(k.code AS FLOAT) END AS c_mktsegment
FROM customer LEFT JOIN k USING (c_mktsegment)
""")
def q_encode_saved(spark, d):
    """EN1 with a mapping that was saved, loaded, and lacks a value."""
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    path = io.scratch_path(spark, "mapping")
    encode.ordinal_encode(c.where(F.col("c_mktsegment") != "MACHINERY"), ["c_mktsegment"], save_to=path)
    out, _ = encode.ordinal_encode(c, ["c_mktsegment"], mapping=encode.load_mapping(spark, path), handle_unknown=True)
    return out


@query("first_seen_encode", f"""
WITH tr AS ({_EVENT_TRANSITIONS}),
firsts AS (SELECT diff_cat_event_type AS v, min(struct_pack(u := user_id, t := ts, e := event_id)) AS pos
           FROM tr WHERE diff_cat_event_type IS NOT NULL GROUP BY 1),
codes AS (SELECT v, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS code FROM firsts)
SELECT tr.event_id, codes.code AS diff_cat_event_type
FROM tr LEFT JOIN codes ON tr.diff_cat_event_type = codes.v
""")
def q_first_seen_encode(spark, d):
    tr = _event_transitions(spark, d)
    out = encode.first_seen_encode(tr, ["diff_cat_event_type"], ["user_id", "ts", "event_id"])
    return out.select("event_id", "diff_cat_event_type")


@query("hash_cats", """
SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS first_priority,
       min(o_orderkey) OVER (PARTITION BY o_orderstatus) AS first_status, o_orderstatus IS NULL AS status_null
FROM (SELECT o_orderkey, o_orderpriority, NULLIF(o_orderstatus, 'P') AS o_orderstatus FROM orders)
""")
def q_hash_cats(spark, d):
    """Hash values differ by engine: each row shows the first row whose hash
    equals its own, which must be the first row with its value."""
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"))
    h = encode.hash_columns(o, ["o_orderpriority", "o_orderstatus"])
    for c, name in (("o_orderpriority", "first_priority"), ("o_orderstatus", "first_status")):
        first = h.groupBy(F.col(c).alias("__h")).agg(F.min("o_orderkey").alias(name))
        h = h.join(first, F.col(c).eqNullSafe(F.col("__h")), "left").drop("__h")
    return h.select("o_orderkey", "first_priority", "first_status", F.col("o_orderstatus").isNull().alias("status_null"))


@query("hex_key", """
SELECT c_custkey, CAST(CAST('0x' || right(md5(c_name), 16) AS UBIGINT) AS VARCHAR) AS customer_int
FROM customer
""")
def q_hex_key(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", hex_tail_to_uint64(F.md5("c_name")).cast("string").alias("customer_int"))


# ---------------------------------------------------------------------------
# Splits (SP1-SP4)
# ---------------------------------------------------------------------------

_PERM = "(o_orderkey * 2654435761 + 1) % 4294967296"


@query("exact_split", f"""
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_PERM}, o_orderkey)
                            <= CAST(floor(0.75 * count(*) OVER ()) AS BIGINT)
                       THEN 'train' ELSE 'test' END AS part
FROM orders
""")
def q_exact_split(spark, d):
    o = t(spark, d, "orders").select("o_orderkey")
    perm = F.pmod(F.col("o_orderkey") * F.lit(2654435761) + F.lit(1), F.lit(4294967296))
    lab = split.split_labels(o, 0.75, order=perm, tiebreak=["o_orderkey"])
    return lab.select("o_orderkey", F.when(F.col("__train"), "train").otherwise("test").alias("part"))


@query("boundary_split", """
WITH k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey),
s AS (SELECT o_custkey, sum(cnt) OVER (ORDER BY o_custkey) - cnt AS start FROM k)
SELECT o.o_orderkey,
       CASE WHEN s.start < CAST(floor(0.75 * (SELECT count(*) FROM orders)) AS BIGINT) THEN 'train' ELSE 'test' END
         AS part
FROM orders o JOIN s USING (o_custkey)
""")
def q_boundary_split(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    lab = split.boundary_labels(o, "o_custkey", 0.75)
    return lab.select("o_orderkey", F.when(F.col("__train"), "train").otherwise("test").alias("part"))


@query("chunks", """
WITH RECURSIVE k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey),
s AS (SELECT o_custkey, sum(cnt) OVER (ORDER BY o_custkey) - cnt AS start,
             sum(cnt) OVER (ORDER BY o_custkey) - 1 AS "end" FROM k),
tot AS (SELECT count(*) AS n, count(*) // 5 AS step FROM orders),
b(i, p) AS (
  SELECT 0, CAST(0 AS HUGEINT)
  UNION ALL
  SELECT b.i + 1, s."end" + 1
  FROM b, tot, s
  WHERE b.p + tot.step + 1 < tot.n AND s.start <= b.p + tot.step AND s."end" >= b.p + tot.step
    AND s."end" + 1 < tot.n
)
SELECT o.o_orderkey, CAST((SELECT max(i) FROM b WHERE b.p <= s.start) AS INTEGER) AS chunk
FROM orders o JOIN s USING (o_custkey)
""")
def q_chunks(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return split.chunk_labels(o, "o_custkey", 5).select("o_orderkey", "chunk")


def _kfold_sql(k: int = 5) -> str:
    def cnt(m: str, i: int) -> str:
        return f"greatest(0, floor(({m} - {i} + {k - 1}) / {k}))"
    acc, terms = [], []
    for f in range(k - 1):
        acc.append(f"({cnt('S + N', f)} - {cnt('S', f)})")
        terms.append(f"CASE WHEN r >= {' + '.join(acc)} THEN 1 ELSE 0 END")
    return f"""
WITH cls AS (SELECT quality, count(*) AS N, min(doc_id) AS first_key FROM labels GROUP BY quality),
st AS (SELECT quality, N, sum(N) OVER (ORDER BY first_key) - N AS S FROM cls),
r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS r FROM labels)
SELECT r.doc_id, r.quality, CAST({' + '.join(terms)} AS INTEGER) AS fold
FROM r JOIN st USING (quality)
"""


@query("kfold", _kfold_sql(5))
def q_kfold(spark, d):
    lab = t(spark, d, "labels").select("doc_id", "quality")
    return split.stratified_folds(lab, "quality", ["doc_id"], k=5)


# ---------------------------------------------------------------------------
# Cumulative shares, metric, losses (CU1, SO3, SO4, ME1-ME6)
# ---------------------------------------------------------------------------

@query("cum_share", """
SELECT p_partkey,
       CAST(sum(p_retailprice) OVER (ORDER BY p_retailprice DESC, p_partkey ROWS UNBOUNDED PRECEDING)
            / sum(p_retailprice) OVER () AS FLOAT) AS cum_share
FROM part
""")
def q_cum_share(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_retailprice")
    out = cumulative.normalize_cumsum(p, "p_retailprice", ["p_partkey"], name="cum_share")
    return out.select("p_partkey", _f("cum_share").alias("cum_share"))


_SCORED = """
SELECT l.doc_id, CAST(d.n_chars AS DOUBLE) AS prediction, CAST(l.quality AS DOUBLE) AS target
FROM labels l JOIN documents d USING (doc_id)
"""


def _scored(spark, d):
    lab = t(spark, d, "labels")
    docs = t(spark, d, "documents").select("doc_id", "n_chars")
    return lab.join(docs, on="doc_id", how="inner").select(
        "doc_id", F.col("n_chars").cast("double").alias("prediction"),
        F.col("quality").cast("double").alias("target"))


@query("rank_metric", f"""
WITH s AS ({_SCORED}),
tot AS (SELECT sum(target) AS n_pos, count(*) - sum(target) AS n_neg FROM s),
c AS (SELECT s.*, 20.0 - 19.0 * target AS w,
             sum(20.0 - 19.0 * target) OVER (ORDER BY prediction DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cw,
             sum(target) OVER (ORDER BY prediction DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cy
      FROM s),
agg AS (SELECT sum(CASE WHEN cw / (n_pos + 20.0 * n_neg) <= 0.04 THEN target ELSE 0 END) / n_pos AS d,
               sum((cy / n_pos - cw / (n_pos + 20.0 * n_neg)) * w)
                 / (10.0 * n_neg * (1 - 19.0 / (n_pos + 20.0 * n_neg))) AS g
        FROM c, tot GROUP BY n_pos, n_neg)
SELECT CAST(0.5 * (g + d) AS FLOAT) AS amex, CAST(d AS FLOAT) AS default_rate, CAST(g AS FLOAT) AS gini FROM agg
""")
def q_rank_metric(spark, d):
    m = metric.ranking_metric_table(_scored(spark, d), "prediction", "target", ["doc_id"])
    return m.select(*[_f(c).alias(c) for c in m.columns])


@query("metric_evaluator", f"""
WITH s AS ({_SCORED}),
tot AS (SELECT sum(target) AS n_pos, count(*) - sum(target) AS n_neg FROM s),
c AS (SELECT s.*, 20.0 - 19.0 * target AS w,
             sum(20.0 - 19.0 * target) OVER (ORDER BY prediction DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cw,
             sum(target) OVER (ORDER BY prediction DESC, doc_id ROWS UNBOUNDED PRECEDING) AS cy
      FROM s)
SELECT CAST(0.5 * (sum(CASE WHEN cw / (n_pos + 20.0 * n_neg) <= 0.04 THEN target ELSE 0 END) / n_pos
                   + sum((cy / n_pos - cw / (n_pos + 20.0 * n_neg)) * w)
                     / (10.0 * n_neg * (1 - 19.0 / (n_pos + 20.0 * n_neg)))) AS FLOAT) AS score,
       max(n_pos + n_neg) AS n_rows
FROM c, tot GROUP BY n_pos, n_neg
""")
def q_metric_evaluator(spark, d):
    """ME3 on the raw score, whose sigmoid keeps the order."""
    s = _scored(spark, d).withColumn("raw", F.col("prediction") / 1e6)
    e = metric.RankingMetricEvaluator("raw", "target", rawScore=True, tiebreakCols=["doc_id"])
    value = e.evaluate(s)
    return s.agg(F.lit(value).cast("float").alias("score"), F.count(F.lit(1)).cast("double").alias("n_rows"))


@query("top_fraction", f"""
WITH s AS ({_SCORED}),
c AS (SELECT doc_id, target,
             sum(20.0 - 19.0 * target) OVER (ORDER BY prediction DESC, doc_id ROWS UNBOUNDED PRECEDING)
               / sum(20.0 - 19.0 * target) OVER () AS cw FROM s)
SELECT doc_id, target FROM c WHERE cw <= 0.04
""")
def q_top_fraction(spark, d):
    s = _scored(spark, d)
    w = F.lit(20.0) - F.lit(19.0) * F.col("target")
    return cumulative.top_fraction(s, "prediction", w, 0.04, ["doc_id"]).select("doc_id", "target")


_LOSS_SQL_P = "1.0 / (1.0 + exp(-(l_discount * 10 - 0.5)))"


@query("loss_table", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 10 - 0.5 AS raw,
                  CAST(l_returnflag = 'R' AS DOUBLE) AS t FROM lineitem),
y AS (SELECT *, 1.0 / (1.0 + exp(-raw)) AS p FROM x),
z AS (SELECT *, greatest(least(p, 1 - 1e-7), 1e-7) AS pc FROM y)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(p AS FLOAT) AS p,
       CAST(t * ln(pc + 1e-7) + (1 - t + 1e-7) * ln(1 - pc + 1e-7) AS FLOAT) AS ce,
       CAST(t / (pc + 1e-7) - (1 - t + 1e-7) / (1 - pc + 1e-7) AS FLOAT) AS ce_grad,
       CAST(-t / pow(pc + 1e-7, 2) - (1 - t + 1e-7) / pow(1 - pc + 1e-7, 2) AS FLOAT) AS ce_hess,
       CAST(p - t AS FLOAT) AS logit_grad, CAST(p * (1 - p) AS FLOAT) AS logit_hess,
       CAST(p * (2.0 - 2.0 * t + t) - t AS FLOAT) AS beta_grad,
       CAST((t + 2.0 - 2.0 * t) * p * (1 - p) AS FLOAT) AS beta_hess
FROM z
""")
def q_loss_table(spark, d):
    li = t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_discount") * 10 - 0.5).alias("raw"),
        (F.col("l_returnflag") == "R").cast("double").alias("t"))
    out = metric.loss_columns(li, "t", "raw", beta=2.0)
    keep = ["p", "ce", "ce_grad", "ce_hess", "logit_grad", "logit_hess", "beta_grad", "beta_hess"]
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[_f(c).alias(c) for c in keep])


# ---------------------------------------------------------------------------
# Aggregates of labels and folds (AG5-AG7), importance table (ML4), top 70%
# ---------------------------------------------------------------------------

@query("label_totals", """
SELECT CAST(sum(quality) AS BIGINT) AS n_pos, CAST(count(*) - sum(quality) AS BIGINT) AS n_neg, count(*) AS n
FROM labels
""")
def q_label_totals(spark, d):
    return stats.label_totals(t(spark, d, "labels"), "quality")


def _importance_long(spark, d):
    e = t(spark, d, "events")
    return e.groupBy((F.col("user_id") % 5).cast("int").alias("fold"), F.col("event_type").alias("feature")) \
            .agg(F.sum("value").alias("gain"), F.count(F.lit(1)).alias("split"))


_IMPORTANCE_LONG = """
SELECT CAST(user_id % 5 AS INTEGER) AS fold, event_type AS feature, sum(value) AS gain, count(*) AS split
FROM events GROUP BY 1, 2
"""


@query("fold_stats", f"""
WITH l AS ({_IMPORTANCE_LONG})
SELECT feature, CAST(avg(gain) AS FLOAT) AS mean, CAST(stddev_pop(gain) AS FLOAT) AS std,
       CAST(sum(gain) AS FLOAT) AS gain
FROM l GROUP BY feature
""")
def q_fold_stats(spark, d):
    long = _importance_long(spark, d)
    a = stats.fold_stats(long, "gain", ["feature"])
    s = stats.fold_sums(long, "gain", ["feature"])
    j = a.join(s, on="feature", how="inner")
    return j.select("feature", _f("mean").alias("mean"), _f("std").alias("std"), _f("gain").alias("gain"))


def _importance_sql() -> str:
    gains = ", ".join(f"coalesce(sum(CASE WHEN fold = {i} THEN gain END), 0) AS gain_cv_{i:02d}" for i in range(5))
    splits = ", ".join(f"CAST(coalesce(sum(CASE WHEN fold = {i} THEN split END), 0) AS BIGINT) AS split_cv_{i:02d}"
                       for i in range(5))
    gsum = " + ".join(f"gain_cv_{i:02d}" for i in range(5))
    ssum = " + ".join(f"split_cv_{i:02d}" for i in range(5))
    gcols = ", ".join(f"CAST(gain_cv_{i:02d} AS FLOAT) AS gain_cv_{i:02d}" for i in range(5))
    scols = ", ".join(f"split_cv_{i:02d}" for i in range(5))
    return f"""
WITH l AS ({_IMPORTANCE_LONG}),
w AS (SELECT feature AS columns, {gains}, {splits} FROM l GROUP BY feature),
r AS (SELECT *, {gsum} AS g, {ssum} AS s FROM w),
c AS (SELECT *, sum(g) OVER (ORDER BY g DESC, columns ROWS UNBOUNDED PRECEDING) / sum(g) OVER () AS gain_cumsum,
             CAST(sum(s) OVER (ORDER BY s DESC, columns ROWS UNBOUNDED PRECEDING) AS DOUBLE) / sum(s) OVER ()
               AS split_cumsum
      FROM r)
SELECT columns, {gcols}, {scols}, CAST(gain_cumsum AS FLOAT) AS gain_cumsum,
       CAST(split_cumsum AS FLOAT) AS split_cumsum,
       gain_cumsum < 0.999 AS "gain_0.999", split_cumsum < 0.999 AS "split_0.999"
FROM c
"""


@query("importance_table", _importance_sql())
def q_importance_table(spark, d):
    from .plans.selection import importance_table
    imp = importance_table(_importance_long(spark, d))
    flo = [c for c in imp.columns if c.startswith("gain_cv_") or c in ("gain_cumsum", "split_cumsum")]
    return imp.withColumns({c: _f(c) for c in flo})


@query("top_features", f"""
WITH l AS ({_IMPORTANCE_LONG}), s AS (SELECT feature, sum(gain) AS gain FROM l GROUP BY feature)
SELECT feature FROM s ORDER BY gain DESC, feature LIMIT (SELECT CAST(floor(0.7 * count(*)) AS BIGINT) FROM s)
""")
def q_top_features(spark, d):
    s = stats.fold_sums(_importance_long(spark, d), "gain", ["feature"])
    return cumulative.top_share(s, "gain", "feature", 0.7).select("feature")


# ---------------------------------------------------------------------------
# Selectors, sorts, slices, table diff (PR1-PR5, PR11, PR12, PR15, PR16,
# SO1, SO2, SO5, CK1)
# ---------------------------------------------------------------------------

@query("selectors", """
SELECT o_orderkey, o_orderstatus, o_orderstatus || '->' || o_orderpriority AS diff_cat_status_priority,
       o_totalprice, CASE WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END AS price_band,
       coalesce(CAST(NULLIF(o_orderstatus, 'P') AS VARCHAR), 'pending') AS status_filled
FROM orders
""")
def q_selectors(spark, d):
    from .spec import all_except
    o = t(spark, d, "orders")
    o = o.withColumn("diff_cat_status_priority", F.concat("o_orderstatus", F.lit("->"), "o_orderpriority"))
    cats = categorical_columns(o, "both", categorical=("o_orderstatus",))          # PR1 (prefix rule)
    prices = regex_columns(o, r"^o_.*price$")                                       # PR3
    doubles = dtype_columns(o, "double")                                            # PR4
    keep = ["o_orderkey", *cats, *[c for c in prices if c in doubles]]
    o = o.drop(*[c for c in all_except(o, keep)])                                   # PR2 + PR11
    o = o.withColumn("price_band", F.when(F.col("o_totalprice") > 200000, "high").otherwise("low"))  # PR15
    o = o.withColumn("status_filled", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    o = clean.fill_null(o, "pending", ["status_filled"])                            # PR16
    return o.select("o_orderkey", "o_orderstatus", "diff_cat_status_priority", "o_totalprice",
                    "price_band", "status_filled")                                  # PR12


@query("sorted_top", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def q_sorted_top(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(20)


@query("row_slice", """
SELECT o_orderkey, o_custkey FROM (
  SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS i FROM orders)
WHERE i >= 100 AND i < 200
""")
def q_row_slice(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return cumulative.row_slice(o, ["o_custkey", "o_orderkey"], 100, 200)


@query("table_diff", """
SELECT * FROM orders EXCEPT ALL SELECT * FROM orders WHERE o_totalprice > 100000
""")
def q_table_diff(spark, d):
    o = t(spark, d, "orders")
    return clean.table_diff(o, o.where(F.col("o_totalprice") > 100000))


# ---------------------------------------------------------------------------
# Sources and sinks (IO1-IO7): written to a fresh folder under the session's
# checkpoint directory and read back
# ---------------------------------------------------------------------------

@query("io_parquet", "SELECT * FROM orders")
def q_io_parquet(spark, d):
    path = io.scratch_path(spark, "io-parquet")
    io.write_parquet(t(spark, d, "orders"), path)
    return io.read_panel(spark, path)


@query("io_csv", "SELECT * FROM labels")
def q_io_csv(spark, d):
    path = io.scratch_path(spark, "io-csv")
    t(spark, d, "labels").write.mode("overwrite").option("header", True).csv(path)
    return io.read_labels_csv(spark, path, schema="doc_id bigint, quality int, toxic int")


@query("io_report", f"""
WITH l AS ({_IMPORTANCE_LONG})
SELECT feature AS columns, CAST(sum(gain) AS FLOAT) AS feature_importance FROM l GROUP BY feature
""")
def q_io_report(spark, d):
    """IO7: a ranking written as one CSV and read back."""
    s = stats.fold_sums(_importance_long(spark, d), "gain", ["feature"])
    path = io.scratch_path(spark, "report")
    io.write_report_csv(s.select(F.col("feature").alias("columns"), F.col("gain").alias("feature_importance")), path)
    out = spark.read.csv(path, header=True, schema="columns string, feature_importance double")
    return out.select("columns", _f("feature_importance").alias("feature_importance"))


@query("io_chunks", """
WITH RECURSIVE k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey),
s AS (SELECT o_custkey, sum(cnt) OVER (ORDER BY o_custkey) - cnt AS start,
             sum(cnt) OVER (ORDER BY o_custkey) - 1 AS "end" FROM k),
tot AS (SELECT count(*) AS n, count(*) // 5 AS step FROM orders),
b(i, p) AS (
  SELECT 0, CAST(0 AS HUGEINT)
  UNION ALL
  SELECT b.i + 1, s."end" + 1
  FROM b, tot, s
  WHERE b.p + tot.step + 1 < tot.n AND s.start <= b.p + tot.step AND s."end" >= b.p + tot.step
    AND s."end" + 1 < tot.n
)
SELECT o.*, CAST((SELECT max(i) FROM b WHERE b.p <= s.start) AS INTEGER) AS chunk
FROM orders o JOIN s USING (o_custkey)
""")
def q_io_chunks(spark, d):
    o = t(spark, d, "orders")
    labeled = split.chunk_labels(o, "o_custkey", 5)
    path = io.scratch_path(spark, "io-chunks")
    io.write_chunks(labeled, path)
    return io.read_chunk(spark, path)


@query("io_split", """
WITH k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey),
s AS (SELECT o_custkey, sum(cnt) OVER (ORDER BY o_custkey) - cnt AS start FROM k)
SELECT o.* FROM orders o JOIN s USING (o_custkey)
WHERE s.start < CAST(floor(0.75 * (SELECT count(*) FROM orders)) AS BIGINT)
""")
def q_io_split(spark, d):
    path = io.scratch_path(spark, "io-split")
    split.write_boundary_split(t(spark, d, "orders"), "o_custkey", path, 0.75)
    return split.read_split(spark, path, "train")


# ---------------------------------------------------------------------------
# Model selection (ML1-ML3, ME4): SQL for what does not depend on the learner
# ---------------------------------------------------------------------------

DOC_FEATURES = ["n_chars", "n_words", "n_lines", "lang", "source", "toxic"]


def _doc_training_table(spark, d):
    lab = t(spark, d, "labels")
    docs = t(spark, d, "documents").select(
        "doc_id", "n_chars", F.size(F.split("text", r"\s+")).alias("n_words"),
        F.size(F.split("text", "\n")).alias("n_lines"), "lang", "source")
    j = lab.join(docs, on="doc_id", how="inner")
    j, _ = encode.ordinal_encode(j, ["lang", "source"])
    return j.select("doc_id", "quality", *[F.col(c).cast("double").alias(c) for c in DOC_FEATURES])


@query("cv_gbt", f"""
SELECT fold, count(*) AS n_rows, CAST(sum(quality) AS BIGINT) AS n_pos, 10 AS n_trees
FROM ({_kfold_sql(5)}) GROUP BY fold
""")
def q_cv_gbt(spark, d):
    """ML1: the folds' sizes and that every tree is fitted; scores depend on
    the learner, so only that they are in range."""
    from .plans.selection import cross_validate
    cv = cross_validate(_doc_training_table(spark, d), DOC_FEATURES, "quality", ["doc_id"])
    ok = cv.scores.where("score between -1 and 1 or isnan(score)")
    return ok.select("fold", "n_rows", "n_pos", "n_trees")


# Boosted trees of depth 1 on nominal features can be recomputed in SQL: a tree
# orders a feature's categories by their mean residual, cuts where the
# squared sums gain most and gives each side its mean; later trees see the
# residuals of the log loss and count a tenth. Missing values are a category.

def _folds_sql(k: int) -> str:
    """(id, fold) of a table ``base`` (id, y, ...), as ``kfold``."""
    return _kfold_sql(k).replace("FROM labels", "FROM (SELECT id AS doc_id, y AS quality FROM base)")


def _stumps_sql(tag: str, features: str, rounds: int, folds: int) -> str:
    """CTEs ``{tag}t{r}`` (k, id, y, fold, raw): raw scores of all rows after r
    trees of the model that fold k is held out of; ``{tag}b{r}`` (k, feature, gain):
    its splits. Reads ``base``, ``folds`` and ``u`` (id, feature, value); ``features`` is a condition on ``u``."""
    out = [f"{tag}u AS MATERIALIZED (SELECT * FROM u WHERE {features})",
           f"{tag}t0 AS (SELECT k, id, y, fold, 0.0::DOUBLE AS raw FROM base JOIN folds USING (id), (SELECT unnest(range(0, {folds})) AS k))"]
    for r in range(1, rounds + 1):
        residual = "2.0 * y - 1" if r == 1 else "4.0 * (2 * y - 1) / (1 + exp(2.0 * (2 * y - 1) * raw))"
        step = "1.0" if r == 1 else "0.1"
        out += [f"""{tag}v{r} AS (SELECT k, feature, value, count(*)::DOUBLE AS n, sum({residual})::DOUBLE AS s
      FROM {tag}t{r - 1} JOIN {tag}u USING (id) WHERE fold <> k GROUP BY ALL)""",
                f"""{tag}c{r} AS MATERIALIZED (SELECT *, row_number() OVER w AS pos, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
             sum(n) OVER (PARTITION BY k, feature) AS nt, sum(s) OVER (PARTITION BY k, feature) AS st FROM {tag}v{r}
      WINDOW w AS (PARTITION BY k, feature ORDER BY s / n, value NULLS LAST ROWS UNBOUNDED PRECEDING))""",
                f"""{tag}b{r} AS MATERIALIZED (SELECT k, feature, pos AS cut, sl / nl AS lv, (st - sl) / (nt - nl) AS rv,
             (sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt) / nt AS gain FROM {tag}c{r} WHERE nl < nt
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY gain DESC, feature, cut) = 1)""",
                f"""{tag}t{r} AS MATERIALIZED (SELECT t.k, t.id, t.y, t.fold, t.raw + {step} * CASE WHEN c.pos <= b.cut THEN b.lv ELSE b.rv END AS raw
      FROM {tag}t{r - 1} t JOIN {tag}b{r} b USING (k) JOIN {tag}u u ON u.id = t.id AND u.feature = b.feature
      LEFT JOIN {tag}c{r} c ON c.k = t.k AND c.feature = b.feature AND c.value IS NOT DISTINCT FROM u.value)"""]
    held = " UNION ALL ".join(f"SELECT k, {r} AS round, id, y, raw FROM {tag}t{r} WHERE fold = k" for r in range(1, rounds + 1))
    out.append(f"""{tag}m AS MATERIALIZED (SELECT k AS fold, round, CASE WHEN p > 0 AND q > 0 THEN
        (sum((lorenz - share) * w) / (10.0 * q * (1 - 19.0 / (p + 20.0 * q))) + sum(CASE WHEN share <= 0.04 THEN y ELSE 0 END) / p) / 2 END AS metric
      FROM (SELECT *, sum(w) OVER o / (p + 20.0 * q) AS share, sum(y) OVER o / p AS lorenz
            FROM (SELECT *, 20.0 - 19 * y AS w, sum(y) OVER (PARTITION BY k, round)::DOUBLE AS p, sum(1 - y) OVER (PARTITION BY k, round)::DOUBLE AS q FROM ({held}))
            WINDOW o AS (PARTITION BY k, round ORDER BY raw DESC, id ROWS UNBOUNDED PRECEDING)) GROUP BY k, round, p, q)""")
    return ",\n".join(out)


def _boosted_sql(base: str, unpivot: str, folds: int, body: str, result: str) -> str:
    return f"""
WITH base AS MATERIALIZED ({base}),
folds AS MATERIALIZED (SELECT doc_id AS id, fold FROM ({_folds_sql(folds)})),
u AS MATERIALIZED ({unpivot}),
{body}
{result}
"""


DOC_NOMINAL = ["lang", "n_digits", "source"]
_DOC_BASE = """SELECT doc_id AS id, CAST(quality AS DOUBLE) AS y, lang, CAST(len(CAST(n_chars AS VARCHAR)) AS VARCHAR) AS n_digits, source
  FROM labels JOIN documents USING (doc_id)"""
_DOC_LONG = " UNION ALL ".join(f"SELECT id, '{c}' AS feature, {c} AS value FROM base" for c in DOC_NOMINAL)
_ROUNDS_RESULT = """SELECT fold::INTEGER AS fold, round::INTEGER AS round, CAST(metric AS FLOAT) AS metric FROM am
UNION ALL SELECT NULL, round::INTEGER, CAST(avg(metric) AS FLOAT) FROM am GROUP BY round"""


def _doc_nominal_table(spark, d):
    """Labelled documents with three encoded categories, and their sizes."""
    from .plans.training import nominal_sizes
    docs = t(spark, d, "documents").select("doc_id", "lang", "source", F.length(F.col("n_chars").cast("string")).cast("string").alias("n_digits"))
    coded, mapping = encode.ordinal_encode(t(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id"), DOC_NOMINAL)
    return coded, nominal_sizes(mapping)


@query("cv_rounds", _boosted_sql(_DOC_BASE, _DOC_LONG, 5, _stumps_sql("a", "true", 3, 5), _ROUNDS_RESULT))
def q_cv_rounds(spark, d):
    """ML1: the metric of every fold after every tree, and its mean by round."""
    from .plans.selection import cross_validate, cv_rounds
    table, sizes = _doc_nominal_table(spark, d)
    cv = cross_validate(table, DOC_NOMINAL, "quality", ["doc_id"], nominal=sizes, max_iter=3, max_depth=1, staged=True)
    return cv_rounds(cv).select("fold", "round", _f("metric").alias("metric"))


@query("predict", _boosted_sql(_DOC_BASE, _DOC_LONG, 2, _stumps_sql("a", "true", 3, 2), """
SELECT id AS doc_id, CAST(avg(raw) AS FLOAT) AS raw, CAST(avg(1 / (1 + exp(-raw))) AS FLOAT) AS prediction FROM at3 GROUP BY id"""))
def q_predict(spark, d):
    """ME4: every document's raw score and its sigmoid, means over the folds' models."""
    from .plans.selection import cross_validate, predict
    table, sizes = _doc_nominal_table(spark, d)
    cv = cross_validate(table, DOC_NOMINAL, "quality", ["doc_id"], nominal=sizes, folds=2, max_iter=3, max_depth=1)
    return predict(cv.models, table, cv.spec, raw="raw").select("doc_id", _f("raw").alias("raw"), _f("prediction").alias("prediction"))


def _select_sql(rounds: int = 3, folds: int = 5) -> str:
    """Three selection rounds: all features, the best two, the best one."""
    body, results, features = [], [], "true"
    for i, n in enumerate((3, 2, 1)):
        tag = f"s{i}"
        body.append(_stumps_sql(tag, features, rounds, folds))
        splits = " UNION ALL ".join(f"SELECT {r} AS round, feature, gain FROM {tag}b{r}" for r in range(1, rounds + 1))
        body.append(f"""{tag}mean AS (SELECT round, avg(metric) AS m FROM {tag}m GROUP BY round),
{tag}best AS (SELECT round AS best FROM {tag}mean ORDER BY m DESC, round LIMIT 1),
{tag}rank AS MATERIALIZED (SELECT f.feature, coalesce(sum(gain), 0) AS importance FROM (SELECT DISTINCT feature FROM {tag}u) f
   LEFT JOIN (SELECT * FROM ({splits}), {tag}best WHERE round <= best) g ON g.feature = f.feature GROUP BY f.feature)""")
        results.append(f"""SELECT {i}::INTEGER AS round, feature AS "columns", CAST(importance AS FLOAT) AS feature_importance,
       CAST((SELECT avg(m) FROM {tag}mean, {tag}best WHERE round <= best) AS FLOAT) AS score FROM {tag}rank""")
        features = f"feature IN (SELECT feature FROM {tag}rank ORDER BY importance DESC, feature LIMIT {int(0.7 * n)})"
    return _boosted_sql(_DOC_BASE, _DOC_LONG, folds, ",\n".join(body), " UNION ALL ".join(results))


@query("select_features", _select_sql())
def q_select_features(spark, d):
    """ML2, ML3: every round's ranking and score."""
    from .plans.selection import recursive_feature_elimination
    table, sizes = _doc_nominal_table(spark, d)
    rankings: list = []
    _, _, history = recursive_feature_elimination(table, DOC_NOMINAL, "quality", ["doc_id"], nominal=sizes, max_depth=1,
                                                  report_dir=io.scratch_path(spark, "rfe"), rankings=rankings)
    out = None
    for (i, _, score), ranking in zip(history, rankings):
        part = ranking.select(F.lit(i).alias("round"), "columns", _f("feature_importance").alias("feature_importance"),
                              F.lit(score).cast("float").alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


PANEL_NOMINAL = ["diff_cat_o_orderpriority_13", "diff_cat_o_orderstatus_13", "o_orderpriority_13", "o_orderstatus_13"]
_PANEL_BASE = """SELECT o_custkey AS id, CAST(c_mktsegment = 'MACHINERY' AS INTEGER)::DOUBLE AS y, o_orderpriority_13, o_orderstatus_13,
         o_orderpriority_13 || '->' || before_p AS diff_cat_o_orderpriority_13, o_orderstatus_13 || '->' || before_s AS diff_cat_o_orderstatus_13
  FROM (SELECT o_custkey, o_orderpriority AS o_orderpriority_13, o_orderstatus AS o_orderstatus_13,
               lag(o_orderpriority) OVER w AS before_p, lag(o_orderstatus) OVER w AS before_s,
               row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS back
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey))
  JOIN customer ON c_custkey = o_custkey WHERE back = 1"""
_PANEL_LONG = " UNION ALL ".join(f"SELECT id, '{c}' AS feature, {c} AS value FROM base" for c in PANEL_NOMINAL)


@query("cv_panel", _boosted_sql(_PANEL_BASE, _PANEL_LONG, 5, _stumps_sql("a", "true", 3, 5), _ROUNDS_RESULT))
def q_cv_panel(spark, d):
    """ML1 on the feature build's array form: all features are prepared as one
    vector, and four categories of the latest period are sliced from it."""
    from .plans.selection import cross_validate_prepared, cv_rounds, prepare
    from .plans.training import nominal_sizes
    features, mapping = build_features(t(spark, d, "orders"), ORDERS_SPEC, _target(spark, d), drop_key=False, as_array=True, return_mapping=True)
    prepared = prepare(features.where("target IS NOT NULL"), "features", "target", ["o_custkey"], nominal=nominal_sizes(mapping))
    cv = cross_validate_prepared(prepared, PANEL_NOMINAL, max_iter=3, max_depth=1, staged=True)
    return cv_rounds(cv).select("fold", "round", _f("metric").alias("metric"))


# ---------------------------------------------------------------------------
# The full feature build (PL1) - the flagship query
# ---------------------------------------------------------------------------

def panel_features(spark, d):
    o = t(spark, d, "orders")
    return build_features(o, ORDERS_SPEC, _target(spark, d), drop_key=False)


def _panel_features_sql() -> str:
    w = "WINDOW w AS (PARTITION BY o_custkey ORDER BY rank)"
    numeric = ["rank", "o_totalprice", "total_number", "days_since_last_payment"]
    cats = ["o_orderstatus", "o_orderpriority"]
    diffs = [f"CAST({c} - lag({c}) OVER w AS FLOAT) AS diff_{c}" for c in numeric if c != "rank"]
    ratios = [f"CAST({c} AS DOUBLE) / NULLIF(CAST(lag({c}) OVER w AS DOUBLE), 0) AS ratio_{c}"
              for c in numeric if c != "rank"]
    trans = [f"{c} || '->' || lag({c}) OVER w AS diff_cat_{c}" for c in cats]
    values = ["o_orderstatus", "o_totalprice", "o_orderpriority", "Year", "Month", "Day", "total_number",
              "days_since_last_payment"] + [f"diff_{c}" for c in numeric] + [f"ratio_{c}" for c in numeric] \
        + [f"diff_cat_{c}" for c in cats]
    encoded = {"o_orderstatus", "o_orderpriority", "diff_cat_o_orderstatus", "diff_cat_o_orderpriority"}
    float_cast = {"o_totalprice"} | {f"ratio_{c}" for c in numeric}
    piv, outs = [], []
    for c in values:
        for r in range(1, 14):
            n = f'"{c}_{r}"'
            if c == "diff_rank":   # constant on the padded grid
                outs.append(f"CAST({'CASE WHEN total_number > 13 THEN 1.0 END' if r == 1 else '1.0'} AS FLOAT) AS {n}")
                continue
            if c == "ratio_rank":
                outs.append(f"CAST({'NULL' if r == 1 else f'{r}.0 / {r - 1}.0'} AS FLOAT) AS {n}")
                continue
            piv.append(f'max(CASE WHEN rank = {r} THEN "{c}" END) AS "{c}_{r}"')
            if c in encoded:
                outs.append(f"CASE WHEN {n} IS NULL THEN CAST('NaN' AS FLOAT) ELSE "
                            f"CAST(dense_rank() OVER (ORDER BY {n} ASC NULLS LAST) - 1 AS FLOAT) END AS {n}")
            elif c in float_cast:
                outs.append(f"CAST({n} AS FLOAT) AS {n}")
            else:
                outs.append(n)
    stats_cols = ["min", "max", "std", "var", "sum"]
    st = [f"CAST(s.{k}_o_totalprice AS FLOAT) AS {k}_o_totalprice" for k in stats_cols]
    st += ["s.min_o_orderstatus", "s.min_o_orderpriority", "s.max_o_orderstatus", "s.max_o_orderpriority",
           "s.days_from_first_to_last_payment"]
    return f"""
WITH base AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority,
                     CAST(o_orderdate AS DATE) AS date FROM orders),
stats AS (SELECT o_custkey, min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice,
                 stddev_samp(o_totalprice) AS std_o_totalprice, var_samp(o_totalprice) AS var_o_totalprice,
                 sum(o_totalprice) AS sum_o_totalprice,
                 min(o_orderstatus) AS min_o_orderstatus, min(o_orderpriority) AS min_o_orderpriority,
                 max(o_orderstatus) AS max_o_orderstatus, max(o_orderpriority) AS max_o_orderpriority,
                 CAST(date_diff('day', min(date), max(date)) AS INTEGER) AS days_from_first_to_last_payment,
                 CAST(count(*) AS INTEGER) AS total_number
          FROM base GROUP BY o_custkey),
ranked AS (SELECT b.*, s.total_number,
                  row_number() OVER (PARTITION BY b.o_custkey ORDER BY b.date DESC, b.o_orderkey DESC) AS rn
           FROM base b JOIN stats s USING (o_custkey)),
panel AS (SELECT o_custkey, CAST(14 - rn AS INTEGER) AS rank, o_orderstatus, o_totalprice, o_orderpriority,
                 CAST(year(date) AS INTEGER) AS "Year", CAST(month(date) AS INTEGER) AS "Month",
                 CAST(day(date) AS INTEGER) AS "Day", date, total_number
          FROM ranked WHERE rn <= 15),
gaps AS (SELECT *, CAST(date_diff('day', lag(date) OVER w, date) AS INTEGER) AS days_since_last_payment
         FROM panel {w}),
lagged AS (SELECT *, {', '.join(diffs + ratios + trans)}
           FROM gaps {w}),
wide AS (SELECT o_custkey, {', '.join(piv)} FROM lagged GROUP BY o_custkey),
enc AS (SELECT o_custkey, {', '.join(outs)} FROM wide JOIN (SELECT o_custkey, total_number FROM stats) USING (o_custkey))
SELECT enc.*, {', '.join(st)}, CAST(c.c_mktsegment = 'MACHINERY' AS INTEGER) AS target
FROM enc JOIN stats s USING (o_custkey) LEFT JOIN customer c ON enc.o_custkey = c.c_custkey
"""


query("panel_features", _panel_features_sql())(panel_features)


def _exploded(df: DataFrame) -> DataFrame:
    """An array-form result as (key, name, value)."""
    from .plans.features import feature_names
    names = F.array(*[F.lit(n) for n in feature_names(df)])
    return df.select("o_custkey", F.explode(F.arrays_zip(names.alias("name"), F.col("features").alias("value"))).alias("f")) \
             .select("o_custkey", "f.name", "f.value")


def _long_features_sql() -> str:
    values = ["o_orderstatus", "o_totalprice", "o_orderpriority", "Year", "Month", "Day", "total_number", "days_since_last_payment"]
    lagged = ["rank", "o_totalprice", "total_number", "days_since_last_payment"]
    values += [f"diff_{c}" for c in lagged] + [f"ratio_{c}" for c in lagged] + ["diff_cat_o_orderstatus", "diff_cat_o_orderpriority"]
    names = [f"{c}_{r}" for c in values for r in range(1, 14)]
    rows = ", ".join(f"struct_pack(name := '{n}', value := CAST(\"{n}\" AS FLOAT))" for n in names)
    return f"""
SELECT o_custkey, u.name AS name, u.value AS value
FROM (SELECT o_custkey, unnest([{rows}]) AS u FROM ({_panel_features_sql()}))
"""


@query("panel_features_array", _long_features_sql())
def q_panel_features_array(spark, d):
    """PL1 in the array form: the same values as the wide form."""
    o = t(spark, d, "orders")
    return _exploded(build_features(o, ORDERS_SPEC, drop_key=False, as_array=True))


@query("panel_features_loaded", _long_features_sql())
def q_panel_features_loaded(spark, d):
    """PL1 in the array form with a mapping that was fitted, saved and loaded."""
    o = t(spark, d, "orders")
    path = io.scratch_path(spark, "encodings")
    build_features(o, ORDERS_SPEC, drop_key=False, save_mapping_to=path)
    return _exploded(build_features(o, ORDERS_SPEC, drop_key=False, as_array=True, mapping=encode.load_mapping(spark, path)))


@query("panel_fill", """
WITH b AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_totalprice, o_orderkey FROM orders),
r AS (SELECT *, 14 - row_number() OVER (PARTITION BY o_custkey ORDER BY date DESC, o_orderkey DESC) AS rank,
             CAST(count(*) OVER (PARTITION BY o_custkey) AS INTEGER) AS total_number,
             CAST(date_diff('day', lag(date) OVER (PARTITION BY o_custkey ORDER BY date, o_orderkey), date) AS INTEGER) AS gap
      FROM b),
g AS (SELECT k.o_custkey, p.rank FROM (SELECT DISTINCT o_custkey FROM orders) k CROSS JOIN range(1, 14) p(rank))
SELECT g.o_custkey, CAST(g.rank AS INTEGER) AS rank, coalesce(r.total_number, -1) AS total_number,
       coalesce(r.gap, -1) AS days_since_last_payment, coalesce(CAST(year(r.date) AS INTEGER), -1) AS "Year",
       CAST(r.o_totalprice AS FLOAT) AS o_totalprice
FROM g LEFT JOIN r ON g.o_custkey = r.o_custkey AND g.rank = r.rank
""")
def q_panel_fill(spark, d):
    """PL1 with ``filter_fill_null``: integers are -1 in periods a key lacks."""
    wide = build_features(t(spark, d, "orders"), ORDERS_SPEC, drop_key=False, filter_fill_null=True, add_diffs=False)
    cols = ["total_number", "days_since_last_payment", "Year", "o_totalprice"]
    rows = F.array(*[F.struct(F.lit(r).alias("rank"), *[col(f"{c}_{r}").alias(c) for c in cols]) for r in range(1, 14)])
    return wide.select("o_custkey", F.inline(rows))
