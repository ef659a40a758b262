"""The feature build with the reference's default column layout."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from panelwise.functions import hex_tail_to_uint64
from panelwise.plans.features import build_features
from panelwise.spec import DEFAULT_BALANCE_COLUMNS, DEFAULT_CATEGORICAL, DEFAULT_PAYMENT_COLUMNS, PanelSpec

NUMERIC = sorted(set(DEFAULT_BALANCE_COLUMNS) | set(DEFAULT_PAYMENT_COLUMNS) | {"R_1"})


def _panel(spark, n_keys=12):
    rnd = random.Random(4)
    rows = []
    for k in range(n_keys):
        cid = f"{k:048x}{rnd.getrandbits(64):016x}"
        for i in range(1 + k % 13):
            row = {"customer_ID": cid, "S_2": (dt.date(2017, 3, 1) + dt.timedelta(days=31 * i)).isoformat()}
            for c in NUMERIC:
                row[c] = rnd.choice([None, 0.0, rnd.uniform(-1, 1)])
            for c in DEFAULT_CATEGORICAL:
                row[c] = rnd.choice(["CO", "CR", "CL", None]) if c in ("D_63", "D_64") else rnd.choice([0, 1, 2, None])
            rows.append(row)
    schema = ", ".join(["customer_ID string", "S_2 string"] + [f"{c} double" for c in NUMERIC] +
                       [f"{c} {'string' if c in ('D_63', 'D_64') else 'int'}" for c in DEFAULT_CATEGORICAL])
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)


def test_default_layout_end_to_end(spark):
    df = _panel(spark)
    labels = df.select("customer_ID").distinct().withColumn("target", (F.rand(1) > 0.5).cast("int"))
    out = build_features(df, PanelSpec(), labels)
    assert "customer_ID" not in out.columns and out.count() == 12
    cols = set(out.columns)
    # payment gaps with hyphenated names, their lags, transitions and stats
    assert {"B_11-P_2_13", "diff_B_11-P_2_13", "ratio_S_23-P_3_2", "diff_cat_D_63_13", "D_64_7",
            "min_B_30", "max_D_68", "std_P_2", "days_from_first_to_last_payment", "target"} <= cols
    n_num = len(NUMERIC) + len(DEFAULT_BALANCE_COLUMNS) * len(DEFAULT_PAYMENT_COLUMNS)
    # per period: numeric + 11 categorical + Year/Month/Day + total_number + day gap
    #            + diffs and ratios of (rank, numeric, total_number, gap) + 11 transitions
    per_period = n_num + 11 + 3 + 1 + 1 + 2 * (n_num + 3) + 11
    assert len([c for c in out.columns if c.endswith("_13") and not c.startswith(("min_", "max_"))]) == per_period
    types = dict(out.dtypes)
    assert types["D_63_13"] == "float" and types["B_30_13"] == "float" and types["P_2_13"] == "float"
    assert "double" not in set(types.values())           # cast_f32
    r = out.orderBy("days_from_first_to_last_payment").first()
    assert math.isnan(r["D_63_1"])                       # a key with one statement: earlier periods missing


def test_customer_id_to_int(spark):
    df = _panel(spark, 2).select("customer_ID").distinct()
    got = {r[0]: r[1] for r in df.select("customer_ID", hex_tail_to_uint64(F.col("customer_ID"))).collect()}
    assert all(int(v) == int(k[-16:], 16) for k, v in got.items())
