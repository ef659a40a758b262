"""Panel feature build on in-memory edge fixtures (FIXTURES.md section C)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelwise.operators import calendar, lags, pivot, ranks
from panelwise.plans.features import build_features
from panelwise.spec import PanelSpec, col

SPEC = PanelSpec(key="customer_ID", ts="S_2", order=("seq",), categorical=("B_30", "D_63"))
SIZES = {"a": 1, "b": 2, "c": 13, "d": 14, "e": 25}


def _panel(spark):
    rows = []
    for k, n in SIZES.items():
        for i in range(n):
            day = dt.date(2020, 1, 1) + dt.timedelta(days=30 * i)
            p2 = float(i) if k != "c" else [0.0, 0.0, 5.0, -2.0, float("nan"), None, 3.0, 0.0, 1.0, 2.0, 4.0,
                                             8.0, 16.0][i]
            b30 = [2, 10, None][i % 3]
            rows.append((f"{k}ffff0000000000000{i % 10}", k, day.isoformat(), i, p2, float(10 + i), b30,
                         ["CO", "CR", None][i % 3], float(i % 4)))
    # two statements on the same date, ordered by seq
    rows.append(("fx", "f", "2020-01-01", 0, 1.0, 1.0, 2, "CO", 0.0))
    rows.append(("fx", "f", "2020-01-01", 1, 3.0, 1.0, 10, "CL", 0.0))
    schema = ("hexid string, customer_ID string, S_2 string, seq int, P_2 double, B_11 double, B_30 int, "
              "D_63 string, X_1 double")
    return spark.createDataFrame(rows, schema).drop("hexid")


def _one(df, key, cols):
    r = df.where(F.col("customer_ID") == key).select(*[col(c) for c in cols]).collect()
    assert len(r) == 1
    return r[0]


def test_shapes_and_ranks(spark):
    out = build_features(_panel(spark), SPEC, balance=("B_11",), payment=("P_2",), drop_key=False)
    assert out.count() == 6
    r = _one(out, "e", ["total_number_13", "total_number_1", "diff_rank_1", "diff_rank_2", "ratio_rank_13"])
    assert r[0] == 25 and r[1] == 25          # all statements count, latest 13 are kept
    assert r[2] == 1.0 and r[3] == 1.0        # a statement precedes period 1
    assert abs(r[4] - 13 / 12) < 1e-6
    r = _one(out, "e", ["diff_P_2_1", "days_since_last_payment_1", "diff_total_number_1"])
    assert tuple(r) == (1.0, 30, 0.0)          # lags see it too
    assert _one(out, "c", ["diff_rank_1", "diff_P_2_1"]) == (None, None)
    r = _one(out, "a", ["P_2_13", "P_2_12", "total_number_13", "days_since_last_payment_13"])
    assert r[0] == 0.0 and r[1] is None and r[2] == 1 and r[3] is None
    # ties on the date: seq decides, the later row is the latest
    r = _one(out, "f", ["P_2_13", "P_2_12", "days_since_last_payment_13", "diff_P_2_13"])
    assert (r[0], r[1], r[2], r[3]) == (3.0, 1.0, 0, 2.0)


def test_ratio_zero_null_nan_negative(spark):
    out = build_features(_panel(spark), SPEC, balance=(), payment=(), drop_key=False, encode=False)
    # key c: P_2 = 0,0,5,-2,NaN,None,3,0,1,2,4,8,16 at ranks 1..13
    r = _one(out, "c", [f"ratio_P_2_{i}" for i in range(1, 14)] + [f"diff_P_2_{i}" for i in range(1, 14)])
    ratios, diffs = list(r[:13]), list(r[13:])
    assert ratios[0] is None                 # first period
    assert ratios[1] is None                 # 0/0
    assert ratios[2] is None                 # 5/0
    assert ratios[3] == pytest.approx(-0.4)  # negative
    assert ratios[4] is None and ratios[5] is None and ratios[6] is None   # NaN and NULL neighbours
    assert ratios[8] is None and ratios[9] == 2.0
    assert diffs[3] == pytest.approx(-7.0) and diffs[4] is None


def test_ieee_ratios_without_filter(spark):
    out = build_features(_panel(spark), SPEC, balance=(), payment=(), drop_key=False, encode=False,
                         run_filter=False)
    r = _one(out, "c", ["ratio_P_2_2", "ratio_P_2_3", "ratio_P_2_4"])
    assert r[0] is None or math.isnan(r[0]) is False  # 0/0 is NaN, which becomes NULL
    assert r[1] == float("inf")
    assert r[2] == pytest.approx(-0.4)


def test_categorical_codes_numeric_order_and_missing(spark):
    out = build_features(_panel(spark), SPEC, balance=(), payment=(), drop_key=False)
    # B_30 holds 2 and 10 as numbers: 2 sorts first
    r = _one(out, "b", ["B_30_12", "B_30_13", "D_63_12", "D_63_13", "B_30_1"])
    assert r[0] == 0.0 and r[1] == 1.0
    assert r[2] == 0.0 and r[3] == 2.0       # rank 13 holds CL < CO < CR
    assert math.isnan(r[4])                   # missing period -> NaN code
    types = dict(out.dtypes)
    assert types["B_30_13"] == "float" and types["diff_cat_B_30_13"] == "float"
    assert types["min_B_30"] == "int" and types["std_P_2"] == "float"


def test_saved_mapping_and_unknown_values(spark, tmp_path):
    df = _panel(spark)
    path = str(tmp_path / "mapping")
    out, mapping = build_features(df, SPEC, balance=(), payment=(), drop_key=False, save_mapping_to=path,
                                  return_mapping=True)
    again = build_features(df, SPEC, balance=(), payment=(), drop_key=False,
                           mapping=spark.read.parquet(path))
    norm = lambda rows: sorted(repr(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r))  # noqa
                               for r in rows)
    assert norm(out.collect()) == norm(again.select(*out.columns).collect())
    unseen = df.withColumn("D_63", F.when(F.col("D_63") == "CO", "ZZ").otherwise(F.col("D_63")))
    with pytest.raises(Exception):
        build_features(unseen, SPEC, balance=(), payment=(), mapping=spark.read.parquet(path)).collect()
    ok = build_features(unseen, SPEC, balance=(), payment=(), drop_key=False,
                        mapping=spark.read.parquet(path), handle_unknown_encodings=True)
    assert ok.count() == 6


def test_legacy_name_filter_and_hyphen_names(spark):
    base = build_features(_panel(spark), SPEC, balance=("B_11",), payment=("P_2",), drop_key=False, encode=False)
    assert "diff_X_1_5" in base.columns and "ratio_B_11-P_2_13" in base.columns
    legacy = build_features(_panel(spark), SPEC, balance=("B_11",), payment=("P_2",), drop_key=False,
                            encode=False, legacy_name_filter=True)
    assert "diff_X_1_5" not in legacy.columns and "ratio_X_1_5" not in legacy.columns
    dropped = build_features(_panel(spark), SPEC, balance=("B_11",), payment=("P_2",), drop_key=False,
                             encode=False, drop_first=True)
    assert "diff_P_2_1" not in dropped.columns and "diff_P_2_2" in dropped.columns


def test_grid_elision_equals_padded_grid(spark):
    """R1: lags computed without the key x rank grid equal those on the
    padded grid, for every key and period."""
    df = calendar.cast_dates(_panel(spark).drop("X_1"), SPEC)
    spec = SPEC.with_(ts="date")
    padded = ranks.full_ranks(df, spec).drop("seq")
    padded = calendar.days_between(padded, "customer_ID", [F.col("rank")])
    padded = lags.diff_ratio(padded, "customer_ID", ["rank"], categorical=SPEC.categorical)
    values = [c for c in padded.columns if c not in ("customer_ID", "rank")]
    want = pivot.pivot_periods(padded, "customer_ID", "rank", 13, values)
    got = build_features(_panel(spark).drop("X_1"), SPEC, balance=(), payment=(), drop_key=False,
                         encode=False, add_stats=False, cast_f32=False)
    assert sorted(want.columns) == sorted(got.columns)
    cols = sorted(want.columns)
    norm = lambda rows: sorted(repr(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r))  # noqa
                               for r in rows)
    assert norm(want.select(*[col(c) for c in cols]).collect()) == norm(got.select(*[col(c) for c in cols]).collect())


def test_fill_null_option(spark):
    out = build_features(_panel(spark), SPEC, balance=(), payment=(), drop_key=False, encode=False,
                         filter_fill_null=True)
    r = _one(out, "a", ["days_since_last_payment_13", "B_30_13"])
    assert r[0] == -1
    assert isinstance(r[1], int)
    r = _one(out, "a", ["days_since_last_payment_12", "Year_3", "total_number_12", "total_number_13", "P_2_12", "B_30_12"])
    assert tuple(r) == (-1, -1, -1, 1, None, None)  # periods the key lacks are filled too


def test_array_form_equals_wide_form(spark):
    from panelwise.operators.pivot import pivot_to_array
    df = calendar.cast_dates(_panel(spark).drop("X_1", "D_63"), SPEC)
    p = ranks.latest_periods(df, SPEC.with_(ts="date")).drop("seq", "date")
    values = [c for c in p.columns if c not in ("customer_ID", "rank")]
    wide = pivot.pivot_periods(p, "customer_ID", "rank", 13, values)
    arr, names = pivot_to_array(p, "customer_ID", "rank", 13, values)
    w = {r["customer_ID"]: r for r in wide.collect()}
    for r in arr.collect():
        nn = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)  # noqa
        got = [nn(g) for g in r["features"]]
        want = [nn(w[r["customer_ID"]][n]) for n in names]
        assert [None if g is None else pytest.approx(g, rel=1e-6) for g in got] == want
    out = build_features(_panel(spark), SPEC, balance=(), payment=(), drop_key=False, as_array=True)
    assert dict(out.dtypes)["features"] == "array<float>" and out.count() == 6


def test_pivot_ignores_out_of_range_ranks_and_keeps_keys(spark):
    rows = [("k1", 1, 1.0, "a"), ("k1", 3, 3.0, "c"), ("k1", 5, 5.0, "e"),  # rank 5 > periods
            ("k2", 4, 4.0, "d"), ("k3", 0, 0.0, "z"), ("k3", 2, None, None)]
    df = spark.createDataFrame(rows, "k string, rank int, v double, s string")
    out = {r["k"]: r.asDict() for r in pivot.pivot_periods(df, "k", "rank", 3).collect()}
    assert set(out) == {"k1", "k2", "k3"}
    assert list(out["k1"]) == ["k", "v_1", "v_2", "v_3", "s_1", "s_2", "s_3"]
    assert out["k1"] == {"k": "k1", "v_1": 1.0, "v_2": None, "v_3": 3.0, "s_1": "a", "s_2": None, "s_3": "c"}
    assert all(v is None for n, v in out["k2"].items() if n != "k")
    assert all(v is None for n, v in out["k3"].items() if n != "k")


def test_key_stats_of_text(spark):
    from panelwise.operators.stats import key_stats
    rows = [("k1", "b", None, 1.0), ("k1", "a", None, 2.0), ("k1", None, None, 3.0), ("k2", None, None, 4.0),
            ("k3", "é", None, 5.0), ("k3", "z", None, 6.0), (None, "Z", None, 7.0)]
    df = spark.createDataFrame(rows, "k string, c string, empty string, v double")
    got = {r["k"]: r.asDict() for r in key_stats(df, "k", ["c", "empty"], date=None).collect()}
    assert (got["k1"]["min_c"], got["k1"]["max_c"]) == ("a", "b")
    assert (got["k2"]["min_c"], got["k2"]["max_c"], got["k2"]["min_empty"]) == (None, None, None)
    assert (got["k3"]["min_c"], got["k3"]["max_c"], got[None]["min_c"]) == ("z", "é", "Z")


def _values(df, wide):
    """{(key, name): value} of the wide or the array form; NaN as text."""
    from panelwise.plans.features import feature_names
    out = {}
    for r in df.collect():
        pairs = zip(feature_names(df), r["features"]) if not wide else r.asDict().items()
        for n, v in pairs:
            if wide is False or n in wide:
                out[r["customer_ID"], n] = "nan" if isinstance(v, float) and math.isnan(v) else v if v is None else float(v)
    return out


@pytest.mark.parametrize("kind", ["int", "text"])
@pytest.mark.parametrize("n", [40, 700])  # below and above the bound of inlined codes
def test_array_and_wide_codes_agree(spark, kind, n, tmp_path):
    rows = [(f"k{i % 350}", (dt.date(2020, 1, 1) + dt.timedelta(days=i // 350)).isoformat(), i,
             i * 10 % (10 * n) if kind == "int" else f"c{i % n:04d}", float(i % 9)) for i in range(2100)]
    df = spark.createDataFrame(rows, f"customer_ID string, S_2 string, seq int, B_30 {'int' if kind == 'int' else 'string'}, P_2 double")
    spec = PanelSpec(key="customer_ID", ts="S_2", order=("seq",), categorical=("B_30",), periods=4)
    if n == 700:  # one rank alone has more codes than are inlined
        df = df.withColumn("customer_ID", F.concat(F.lit("k"), F.col("seq").cast("string")))
    path = str(tmp_path / "codes")
    wide = build_features(df, spec, drop_key=False, save_mapping_to=path)
    loaded = spark.read.parquet(path)
    array = build_features(df, spec, drop_key=False, as_array=True)
    from panelwise.plans.features import feature_names
    names = set(feature_names(array))
    assert {"total_number_4", "diff_rank_2", "B_30_4"} <= names <= set(wide.columns)
    want = _values(wide, names)
    for other in (array, build_features(df, spec, drop_key=False, as_array=True, mapping=loaded)):
        assert _values(other, False) == want
    assert _values(build_features(df, spec, drop_key=False, mapping=loaded), names) == want
    codes = sorted({v for (_, c), v in want.items() if c == "B_30_4" and v != "nan"})
    assert codes == [float(i) for i in range(len(codes))] and (n < 512) == (len(codes) <= 512)
    unseen = df.withColumn("B_30", F.lit("-5" if kind == "int" else "zz").cast(df.schema["B_30"].dataType))
    with pytest.raises(Exception, match="unknown category"):
        build_features(unseen, spec, as_array=True, mapping=loaded).collect()


def test_label_columns_are_coded_and_saved(spark, tmp_path):
    labels = spark.createDataFrame([("a", "x"), ("b", "y"), ("zz", "w")], "customer_ID string, B_30_group string")
    path = str(tmp_path / "codes")
    first = build_features(_panel(spark), SPEC, labels, balance=(), payment=(), drop_key=False, save_mapping_to=path)
    assert _one(first, "a", ["B_30_group"])[0] == 0.0 and _one(first, "b", ["B_30_group"])[0] == 1.0
    again = build_features(_panel(spark), SPEC, labels.where("customer_ID <> 'zz'"), balance=(), payment=(), drop_key=False,
                           mapping=spark.read.parquet(path))
    assert _one(again, "b", ["B_30_group"])[0] == 1.0


def test_null_keys_are_a_key(spark):
    df = _panel(spark).withColumn("customer_ID", F.when(F.col("customer_ID") != "b", F.col("customer_ID")))
    out = build_features(df, SPEC, balance=(), payment=(), drop_key=False)
    assert out.count() == 6 and out.where("customer_ID is null").count() == 1
    spec, dated = SPEC.with_(ts="date"), calendar.cast_dates(df, SPEC)
    assert ranks.add_rank(dated, spec).count() == dated.count()
    full = ranks.full_ranks(dated, spec)
    assert full.where("customer_ID is null and rank between 1 and 13").count() == 13
    assert full.count() == 6 * 13 + 1 + 12     # keys d and e keep 1 and 12 earlier statements
    assert ranks.index_and_count(dated, "customer_ID", ["customer_ID", "seq"]).count() == dated.count()


def test_source_is_read_twice(spark, tmp_path):
    n = spark.sparkContext.accumulator(0)
    path = str(tmp_path / "panel")
    _panel(spark).write.parquet(path)
    df = spark.read.parquet(path)
    rows = df.count()

    def seen(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    out = build_features(df.mapInArrow(seen, df.schema), SPEC, balance=(), payment=(), drop_key=False)
    out.write.format("noop").mode("overwrite").save()
    assert n.value == 2 * rows


def test_array_pivot_builds_a_key_s_map_once(spark):
    from panelwise.operators.pivot import pivot_to_array
    rows = [(1, 1, 1.0, 5), (1, 3, 2.0, None), (2, 2, None, 7), (None, 1, 4.0, 8), (2, 9, 6.0, 6)]
    df = spark.createDataFrame(rows, "k long, rank int, a double, b int")
    arr, names = pivot_to_array(df, "k", "rank", 3, ["a", "b"])
    assert names == ["a_1", "a_2", "a_3", "b_1", "b_2", "b_3"]
    got = {r["k"]: list(r["features"]) for r in arr.collect()}
    assert got == {1: [1.0, None, 2.0, 5.0, None, None], 2: [None, None, None, None, 7.0, None],
                   None: [4.0, None, None, 8.0, None, None]}
    plan = arr._jdf.queryExecution().optimizedPlan().toString()
    # inside a lambda the map would be built anew for every element
    assert not any("lambdafunction" in x and "map_from_entries" in x for x in plan.splitlines())
