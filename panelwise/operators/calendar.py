"""Date handling of a panel (PR6, RN11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import GAP_COLUMN, PanelSpec, col


def cast_dates(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Parse the statement date and add ``Year``, ``Month``, ``Day`` and
    ``date``; the original date column is dropped.

    A string date is parsed strictly with ``spec.ts_format`` (a bad value
    raises under ANSI mode, as the reference's strict parse does)."""
    ts_type = df.schema[spec.ts].dataType
    src = col(spec.ts)
    if isinstance(ts_type, T.StringType):
        d = F.to_date(src, spec.ts_format)
    elif isinstance(ts_type, T.DateType):
        d = src
    else:
        d = F.to_date(src)
    out = df.withColumn(spec.ts, d)
    out = out.withColumns({
        "Year": F.year(col(spec.ts)),
        "Month": F.month(col(spec.ts)),
        "Day": F.dayofmonth(col(spec.ts)),
    })
    if spec.ts != "date":
        out = out.withColumn("date", col(spec.ts)).drop(spec.ts)
    else:
        out = out.select(*[c for c in out.columns if c != "date"], "date")
    return out


def days_between(df: DataFrame, key: str, order: list, name: str = GAP_COLUMN,
                 drop_date: bool = True) -> DataFrame:
    """Days since the previous statement of the same key (NULL on the
    first); drops ``date``. ``order`` must be bounded per key (a panel of
    ``periods`` rows); for unbounded histories use ``ordered_scan`` lags."""
    w = Window.partitionBy(col(key)).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    out = df.withColumn(name, F.datediff(col("date"), F.lag(col("date")).over(w)))
    return out.drop("date") if drop_date else out


def days_since_previous(df: DataFrame, key: str, order: list, name: str = GAP_COLUMN,
                        date: str = "date") -> DataFrame:
    """RN11 over full histories (no ``periods`` bound): the previous date
    comes from the segmented ordered scan, so a key with a large share of
    all rows is split over many tasks."""
    from .scan import ordered_scan
    out = ordered_scan(df, order, segment=key, lags={"__prev_date": date})
    return out.withColumn(name, F.datediff(col(date), F.col("__prev_date"))).drop("__prev_date")
