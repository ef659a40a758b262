"""Lags over spread keys, and chunk chains in few jobs."""

import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from panelwise.operators import lags, ranks, split
from panelwise.operators.lags import diff_ratio, with_halo
from panelwise.spec import PanelSpec


def history(spark, n=4000):
    """One key with a third of the rows, NULL keys and values, zero denominators."""
    rng = random.Random(4)
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i % 200, i, rng.choice([None, 0.0, 1.5, -2.0, float("nan")]),
             rng.choice(["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, t long, x double, c string").repartition(6)


@pytest.fixture
def many_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("kw", [{}, {"float32_ratio": True}, {"ieee": True}, {"fill_transitions": True}])
@pytest.mark.parametrize("order", [["t"], ["t DESC"]])
def test_halo_equals_window(spark, many_partitions, kw, order):
    df = history(spark)
    made = {s: diff_ratio(df, "k", order, categorical=["c"], numeric=["x", "t"], strategy=s, **kw) for s in ("window", "halo")}
    assert made["halo"].columns == made["window"].columns
    assert rows_of(made["halo"]) == rows_of(made["window"])


def test_large_keys_are_spread_and_no_window_is_per_key(spark, many_partitions):
    df = history(spark)
    held = with_halo(df, "k", ["t"])
    per = held.where("not __lag_halo and k = 7").groupBy("__lag_part").count().collect()
    assert len(per) >= 3 and max(r["count"] for r in per) <= 4000 / 8 * 2
    plan = diff_ratio(df, "k", ["t"], categorical=["c"], numeric=["x"], strategy="halo")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "lag(" in line]
    assert windows and all("windowspecdefinition(__lag_part" in line for line in windows)
    assert "Python" not in plan and "Arrow" not in plan


def test_auto_measures_the_largest_key(spark, monkeypatch):
    df = history(spark, 300)
    monkeypatch.setattr(lags, "WINDOW_MAX_ROWS", 40)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "__lag_part" in plan(diff_ratio(df, "k", ["t"], numeric=["x"]))
    assert "__lag_part" not in plan(diff_ratio(df.where("k <> 7"), "k", ["t"], numeric=["x"]))
    assert "__lag_part" not in plan(diff_ratio(df, "k", ["t"], numeric=["x"], largest=5))


def test_rank_by_windows_equals_rank_by_scan(spark, monkeypatch):
    df = history(spark, 900)
    spec = PanelSpec(key="k", ts="t", order=("x", "c"), categorical=("c",))
    small = rows_of(ranks.add_rank(df, spec))
    monkeypatch.setattr(ranks, "WINDOW_MAX_ROWS", 10)
    from panelwise.operators import scan
    monkeypatch.setattr(scan, "WINDOW_MAX_ROWS", 10)
    assert rows_of(ranks.add_rank(df, spec)) == small


def chain(counts, n):
    """Chunk of every key by walking the rows."""
    total = sum(c for _, c in counts)
    step, start, chunk, first, out = total // n, 0, 0, 0, {}
    for k, c in counts:
        if start > first + step:
            chunk, first = chunk + 1, start
        out[k] = chunk
        start += c
    return out


def chunked(spark, counts, n, **kw):
    df = spark.createDataFrame([(k, i) for k, c in counts for i in range(c)], "k long, i long")
    tot = {}
    starts = split.key_starts(df, "k", tot)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "chunks")
    bounds = split.chunk_bounds(starts, "k", int(tot["__cum"]), n, **kw)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {k: sum(b[0] <= k for b in bounds) for k, _ in counts}
    return got, jobs


def test_chunk_chain_takes_the_same_jobs_for_any_n(spark):
    rng = random.Random(1)
    counts = [(k, rng.randint(1, 13)) for k in range(4000)]
    jobs = set()
    for n in (5, 50, 500):
        got, used = chunked(spark, counts, n)
        assert got == chain(counts, n)
        jobs.add(used)
    assert len(jobs) == 1


def test_chunk_chain_in_small_windows_and_with_a_large_key(spark):
    rng = random.Random(2)
    counts = [(k, rng.randint(1, 9)) for k in range(600)] + [(600, 1500)] + [(k, 1) for k in range(601, 1500)]
    for n in (3, 7, 40):
        for at_once in (2, 30, 10_000):
            got, _ = chunked(spark, counts, n, at_once=at_once)
            assert got == chain(counts, n), (n, at_once)


def test_many_chunks_label_rows_and_null_keys(spark):
    counts = [(k, 3) for k in range(300)]
    df = spark.createDataFrame([(None, 0)] * 2 + [(k, i) for k, c in counts for i in range(c)], "k long, i long")
    want = chain([(None, 2), *counts], 40)
    got = {r.k: r.chunk for r in split.chunk_labels(df, "k", 40).collect()}
    assert got == want and max(got.values()) > 16
    assert math.isclose(split.chunk_labels(df, "k", 3).agg(F.max("chunk")).first()[0], max(chain([(None, 2), *counts], 3).values()))
