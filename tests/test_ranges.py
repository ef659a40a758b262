"""The ordered scan by ranges: same values as windows and the Arrow pass, and
nothing written."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise import session
from panelwise.operators.ranges import Key, as_struct, comparable, deal, recomputable
from panelwise.operators.scan import ordered_scan
from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(map(str, r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("segment,parts", [(None, None), (None, 5), (None, 70), ("o_custkey", 5), ("o_custkey", 70)])
def test_ranges_match_windows(spark, segment, parts):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    order = [Key(F.col("o_totalprice"), descending=True), Key(F.col("o_orderkey"))]
    tot = {}
    got = ordered_scan(o, order, segment=segment, strategy="ranges", num_partitions=parts, totals=tot, count="n", index="i",
                       sums={"cs": F.col("o_totalprice")}, lags={"prev": "o_totalprice", "prevd": "o_orderdate"})
    over = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    w = Window.partitionBy(*[segment] if segment else [F.lit(1)]).orderBy(*over)
    ref = (o.withColumn("cs", F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("n", F.row_number().over(w)).withColumn("prev", F.lag("o_totalprice").over(w))
            .withColumn("prevd", F.lag("o_orderdate").over(w))
            .withColumn("i", F.row_number().over(Window.orderBy(*[segment] if segment else [], *over))))
    cols = ["o_orderkey", F.round("cs", 2).alias("cs"), "n", "prev", "prevd", "i"]
    assert _rows(got, cols) == _rows(ref, cols)
    assert tot["rows"] == o.count()
    if not segment:
        assert abs(tot["cs"] - o.agg(F.sum("o_totalprice")).first()[0]) < 1e-2


values = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, -2.0, float("nan"), float("inf"), float("-inf")]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([None, "", "a", "a", "a", "b"]), values, values), min_size=1, max_size=80),
       parts=st.sampled_from([1, 3, 9, 40]), down=st.booleans(), segmented=st.booleans())
def test_ranges_and_arrow_pass_agree_on_any_values(spark, rows, parts, down, segmented):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, s string, o double, v double")
    both = [ordered_scan(df, [Key(F.col("o"), down), Key(F.col("id"), not down)], segment="s" if segmented else None,
                         sums={"cs": F.col("v")}, count="n", lags={"pv": "v", "ps": "s"}, num_partitions=parts, strategy=k)
            for k in ("ranges", "scan")]
    a, b = (_rows(d, ["id", F.round("cs", 6).alias("cs"), "n", "pv", "ps"]) for d in both)
    assert a == b


KINDS = {
    "long": [None, -2 ** 63, -1, 0, 5, 2 ** 63 - 1],
    "short": [None, -32768, 7, 32767],
    "float": [None, float("nan"), float("inf"), float("-inf"), 0.1, -0.1],
    "decimal(20,3)": [None, -5, 0, 7],
    "boolean": [None, True, False],
    "date": [None, dt.date(1969, 12, 31), dt.date(1970, 1, 2), dt.date(2024, 2, 29)],
    "timestamp": [None, dt.datetime(2024, 10, 27, 0, 30, 0, 1), dt.datetime(1960, 1, 1), dt.datetime(2024, 10, 27, 2, 30)],
    "timestamp_ntz": [None, dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 31, 3, 0), dt.datetime(1960, 1, 1)],
    "string": [None, "", "a", "Z", "é", "日本", "it's", "a\\b"],
}


@pytest.mark.parametrize("down", [False, True])
@pytest.mark.parametrize("kind", sorted(KINDS))
def test_ranges_follow_the_order_of_every_type(spark, kind, down):
    import decimal
    vals = [decimal.Decimal(v) if v is not None and kind.startswith("decimal") else v for v in KINDS[kind]]
    df = spark.createDataFrame([(v,) for v in vals * 3], f"x {kind}")
    key = Key(F.col("x"), down)
    fields = comparable(df, [key])
    if fields is None:
        assert down and kind in ("string", "timestamp_ntz")
        return
    got = [(r.x, r.p) for r in deal(df, fields, "p", 50)[0].orderBy(key.sort()).collect()]
    places = [p for _, p in got]
    assert places == sorted(places) and places[0] != places[-1]
    by_value = {}
    for x, p in got:
        by_value.setdefault(str(x), set()).add(p)
    assert all(len(p) == 1 for p in by_value.values())


def test_nothing_is_written_and_totals_read_narrow_columns(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for wide in (o.select("o_orderkey", "o_totalprice"), o.withColumns({f"x{i}": F.col("o_orderpriority") for i in range(40)})):
        before = len(session._SCRATCH)
        got = ordered_scan(wide, ["o_orderkey"], sums={"cs": F.col("o_totalprice")}, num_partitions=8)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert len(session._SCRATCH) == before
        assert "MapInArrow" not in plan and plan.count("Window ") == 1
        assert got.count() == o.count()


def test_only_inputs_that_can_be_recomputed_go_by_ranges(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert recomputable(o.where("o_orderkey > 5").selectExpr("o_orderkey + 1 AS k"))
    assert recomputable(spark.range(5).union(spark.range(3)))
    for other in (o.withColumn("r", F.rand()), o.limit(5), o.groupBy("o_custkey").count(), o.join(spark.range(9), F.col("id") == F.col("o_orderkey"))):
        assert not recomputable(other)
    with pytest.raises(ValueError):
        ordered_scan(o, [F.col("o_orderkey").desc()], count="n", strategy="ranges")


def test_hot_segment_and_empty_table(spark):
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("t"), F.lit(1.0).alias("v"))
    keys = [Key(F.col("k")), Key(F.col("t"))]
    sizes = deal(df, comparable(df, keys), "p", 30)[0].groupBy("p").count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 4 * n / 30
    hot = ordered_scan(df, ["t"], segment="k", sums={"cv": F.col("v")}, count="n", window_max_rows=n // 10, num_partitions=30).where("k = -1")
    assert sorted((r.n, r.cv) for r in hot.select("n", "cv").collect()) == [(i, float(i)) for i in range(1, n // 3 + 1)]
    tot = {}
    none = ordered_scan(df.where("t < 0"), ["t"], sums={"cv": F.col("v")}, count="n", totals=tot)
    assert none.collect() == [] and tot["rows"] == 0
    assert isinstance(none.schema["cv"].dataType, T.DoubleType)
    assert df.select(as_struct(comparable(df, keys))).count() == n
