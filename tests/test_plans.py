"""Plan properties the scale design relies on (checked on executed plans)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from panelwise import catalog
from panelwise.operators import ranks


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _gathers_rows(plan: str) -> bool:
    """True if some exchange sends whole rows (not one partial aggregate
    row per task) to a single partition."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if not ("HashAggregate" in below and "partial_" in below):
                return True
    return False


def test_latest_periods_limits_before_the_shuffle(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("date", F.to_date("o_orderdate"))
    plan = _plan(ranks.latest_periods(o, catalog.ORDERS_SPEC.with_(ts="date"), with_count=False))
    # the partial limit sits below (is printed after) the exchange on the key
    ex = plan.index("Exchange hashpartitioning(o_custkey")
    assert "WindowGroupLimit" in plan[ex:] and "Partial" in plan


def test_flagship_exchanges_and_pruning(spark):
    plan = _plan(catalog.panel_features(spark, SF_SMALL))
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)
    assert shuffles == ["hashpartitioning", "hashpartitioning"], shuffles
    assert not _gathers_rows(plan)
    # the orders scans read only the columns they need
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert all("o_orderkey" not in s for s in scans if "o_orderstatus" in s and "o_custkey" in s
               and "o_totalprice" in s and "o_orderdate" in s and s.count(",") == 4)


def test_no_single_partition_windows_in_scans(spark):
    for name in ("row_index", "cum_share", "rank_metric", "exact_split", "boundary_split", "chunks", "kfold",
                 "top_fraction", "row_slice", "positional_join", "days_between"):
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert not _gathers_rows(plan), name
