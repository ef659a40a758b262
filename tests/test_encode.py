"""Encoders and hashes."""

import math

import pytest
from pyspark.sql import functions as F

from panelwise.functions import hex_tail_to_uint64
from panelwise.operators import encode


def test_numeric_order_many_categories_and_unknown(spark):
    rows = [(i, i % 300, f"s{i % 7}") for i in range(900)] + [(900, None, None)]
    df = spark.createDataFrame(rows, "id long, n int, s string")
    out, mapping = encode.ordinal_encode(df, ["n", "s"])
    got = {r.id: (r.n, r.s) for r in out.collect()}
    assert got[2] == (2.0, 2.0) and got[10] == (10.0, 3.0)   # 2 < 10 as numbers
    assert got[299][0] == 299.0                                # beyond 255 categories
    assert math.isnan(got[900][0]) and math.isnan(got[900][1])
    new = spark.createDataFrame([(1, 5000, "zz")], "id long, n int, s string")
    with pytest.raises(Exception):
        encode.apply_mapping(new, mapping, ["n", "s"], handle_unknown="error").collect()
    r = encode.apply_mapping(new, mapping, ["n"], handle_unknown="missing").first()
    assert math.isnan(r.n)
    i32, _ = encode.encode_categoricals(df, ["n"])
    assert dict(i32.dtypes)["n"] == "int" and i32.where("id = 900").first().n == -1


def test_join_fallback_equals_literal_maps(spark):
    df = spark.createDataFrame([(i, f"v{i % 13}") for i in range(200)], "id long, s string")
    mapping = encode.fit_ordinal_encoder(df, ["s"])
    a = encode.apply_mapping(df, mapping, ["s"]).orderBy("id").collect()
    b = encode.apply_mapping(df, mapping, ["s"], max_literal_entries=3).orderBy("id").collect()
    assert a == b


def test_first_seen_codes(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None), (4, "c")], "id long, s string")
    out = encode.first_seen_encode(df, ["s"], ["id"]).orderBy("id").collect()
    assert [r.s for r in out] == [0, 1, 0, None, 2]


def test_hash_keeps_null_and_hex_key(spark):
    df = spark.createDataFrame([("x",), (None,)], "B_30 string")
    h = encode.hash_columns(df, ["B_30"]).collect()
    assert h[0].B_30 is not None and h[1].B_30 is None
    hx = spark.createDataFrame([("0000ffffffffffffffff",)], "c string") \
              .select(hex_tail_to_uint64(F.col("c")).alias("v")).first().v
    assert int(hx) == 2 ** 64 - 1


def test_large_mapping_uses_distributed_rank(spark):
    df = spark.createDataFrame([(i, i % 40, f"s{i % 25:02d}") for i in range(400)], "id long, n int, s string")
    small = encode.fit_ordinal_encoder(df, ["n", "s"])
    long = encode._long_values(df, ["n", "s"]).where(F.col("value").isNotNull()).distinct()
    big = encode.codes_from_distinct(long, "sorted", max_rows=10)     # beyond the bound: scan path
    key = lambda d: sorted((r.column, r.value, r.code) for r in d.collect())
    assert key(small) == key(big)
    assert dict((r.value, r.code) for r in small.where("column = 'n'").collect())["10"] == 10


def test_large_column_is_joined_small_column_inlined(spark):
    # 'big' has more codes than one literal map may hold, 's' few: mixed path
    rows = [(i, f"v{i % 600:03d}", f"s{i % 3}") for i in range(1200)] + [(1200, None, None)]
    df = spark.createDataFrame(rows, "id long, big string, s string")
    out, mapping = encode.ordinal_encode(df, ["big", "s"])
    assert mapping.where("column = 'big'").count() > encode.MAX_LITERAL_PER_COLUMN
    got = {r.id: (r.big, r.s) for r in out.collect()}
    assert got[123] == (123.0, 0.0) and got[599] == (599.0, 2.0) and got[1123] == (523.0, 1.0)
    assert math.isnan(got[1200][0]) and math.isnan(got[1200][1])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan  # the large column's mapping is joined, not inlined
    new = spark.createDataFrame([(1, "nope", "s1")], "id long, big string, s string")
    r = encode.apply_mapping(new, mapping, ["big", "s"], handle_unknown="missing").first()
    assert math.isnan(r.big) and r.s == 1.0
    with pytest.raises(Exception):
        encode.apply_mapping(new, mapping, ["big"], handle_unknown="error").collect()
