"""Panel description and column roles.

A panel is a table of dated statements: several rows per entity key. The
reference hard-wires its column names; here they are parameters of a
``PanelSpec``, with the reference's names as defaults.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Must equal the reference's for the default panel layout.
#   categorical statement columns:
#     B_30, B_38, D_114, D_116, D_117, D_120, D_126, D_63, D_64, D_66, D_68
#   prefix of derived category-transition columns: diff_cat
#   calendar columns that are never differenced: Year, Month, Day, date
#   balance columns of the payment gaps: B_11, B_14, B_17, D_39, D_131, S_16, S_23
#   payment columns of the payment gaps: P_2, P_3
#   periods kept per key: 13
#   names: total_number, rank, days_since_last_payment,
#          days_from_first_to_last_payment
# ---------------------------------------------------------------------------
DEFAULT_CATEGORICAL = ("B_30", "B_38", "D_114", "D_116", "D_117", "D_120",
                       "D_126", "D_63", "D_64", "D_66", "D_68")
TRANSITION_PREFIX = "diff_cat"
CALENDAR_COLUMNS = ("Year", "Month", "Day", "date")
DEFAULT_BALANCE_COLUMNS = ("B_11", "B_14", "B_17", "D_39", "D_131", "S_16", "S_23")
DEFAULT_PAYMENT_COLUMNS = ("P_2", "P_3")
DEFAULT_PERIODS = 13
COUNT_COLUMN = "total_number"
RANK_COLUMN = "rank"
GAP_COLUMN = "days_since_last_payment"
SPAN_COLUMN = "days_from_first_to_last_payment"


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns of a panel.

    key        entity column (one output row per value)
    ts         statement date; string (parsed with ``ts_format``), date or timestamp
    order      extra ordering columns that break ties on ``ts``; used only
               for ordering and dropped from the features
    categorical  statement columns treated as categories
    periods    statements kept per key (the most recent ones)
    bounded    True if no key has more than ``periods`` statements: skips the
               per-key limit and its map-side sort. False (default) applies
               the skew-safe limit
    """

    key: str = "customer_ID"
    ts: str = "S_2"
    order: tuple[str, ...] = ()
    categorical: tuple[str, ...] = DEFAULT_CATEGORICAL
    periods: int = DEFAULT_PERIODS
    ts_format: str = "yyyy-MM-dd"
    drop: tuple[str, ...] = field(default_factory=tuple)
    bounded: bool = False

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)

    def order_columns(self, descending: bool = False) -> list[Column]:
        names = ["date" if self.ts == "date" else self.ts, *self.order]
        return [F.col(n).desc() if descending else F.col(n).asc() for n in names]


def col(name: str) -> Column:
    """Column reference that tolerates any character in the name."""
    return F.col(q(name))


def q(name: str) -> str:
    """A column name quoted for SQL expression strings. Wide projections are
    built as one ``selectExpr`` of such strings: one JVM call instead of
    several per column."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(v) -> str:
    """A Python scalar as a Spark SQL literal."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L" if abs(v) > 2**31 - 1 else str(v)
    if isinstance(v, float):
        if v != v:
            return "CAST('NaN' AS DOUBLE)"
        if v in (float("inf"), float("-inf")):
            return f"CAST('{'-' if v < 0 else ''}Infinity' AS DOUBLE)"
        return repr(v) + "D"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return "'" + s + "'"


# ---------------------------------------------------------------------------
# Selectors (PR1-PR4): resolved against the schema on the driver, before the
# plan is built, so Catalyst sees an explicit projection.
# ---------------------------------------------------------------------------

def categorical_columns(columns, kind: str = "both",
                        categorical=DEFAULT_CATEGORICAL,
                        transition_prefix: str = TRANSITION_PREFIX) -> list[str]:
    """Names that begin with one of the prefixes of ``kind``: ``numeric`` the
    categorical names (so pivoted ``B_30_4`` counts), ``string`` the
    transition columns, ``both`` all of them. ``min_B_30`` does not match."""
    prefixes = {"numeric": tuple(categorical), "string": (transition_prefix,),
                "both": (*categorical, transition_prefix)}
    if kind not in prefixes:
        raise ValueError(f"kind is one of {', '.join(prefixes)}, not {kind!r}")
    return [name for name in getattr(columns, "columns", columns) if name.startswith(prefixes[kind])]


def all_except(df, exclude) -> list[str]:
    """Wildcard with exclusion (PR2)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def regex_columns(df, pattern: str) -> list[str]:
    """Names matching a full-match regular expression (PR3)."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.fullmatch(c)]


def drop_regex(df, *patterns: str):
    """Drop every column whose name fully matches one of the patterns (PR3)."""
    rxs = [re.compile(p) for p in patterns]
    return df.drop(*[c for c in df.columns if any(r.fullmatch(c) for r in rxs)])


def dtype_columns(df, *type_names: str) -> list[str]:
    """Names of columns whose simple type name is one of ``type_names``
    (``tinyint smallint int bigint float double string date boolean``) (PR4)."""
    wanted = set(type_names)
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in wanted]


SIGNED_INT_TYPES = ("tinyint", "smallint", "int", "bigint")
FLOAT_TYPES = ("float", "double")
