import zlib
from collections import Counter
from hashlib import md5

from pyspark.sql import functions as F

from panelwise.llm import sharding

from .conftest import make_docs, some_texts


def by_the_book(key, shards):
    state, b, j = int(md5(key.encode()).hexdigest()[:16], 16), -1, 0
    while j < shards:
        b = j
        state = (state * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return b


def test_walk(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    for n in (1, 2, 8, 9, 1000):
        got = keys.select("k", sharding.jump_shard(F.col("k"), n).alias("s")).collect()
        assert all(r["s"] == by_the_book(r["k"], n) for r in got)


def test_walk_that_needs_more_steps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEPS", 2)
    got = spark.range(500).select(F.col("id").cast("string").alias("k"), sharding.jump_shard(F.col("id"), 300).alias("s")).collect()
    assert all(r["s"] == by_the_book(r["k"], 300) for r in got)


def check(docs, got):
    rows = {i: t for i, t in enumerate(docs)}
    assert len(got) == len(rows)
    for r in got:
        t = (r["text"] or "").encode()
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 1, zlib.crc32(t), "key")
        assert (r["shard"], r["grown_shard"]) == (by_the_book(key, 8), by_the_book(key, 9))
        assert r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_documents(spark, docs):
    got = sharding.sharded(docs, docs.columns[:5] + ["block", "fp", "part"]).collect()
    check(docs.collect(), got)
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in got) == Counter((r["doc_id"], r["text"], r["source"]) for r in docs.collect())


def test_slots_do_not_hang_on_the_partitions(spark):
    docs = make_docs(spark, some_texts(200))
    a, b = ({(r["doc_id"], r["shard"], r["slot"]) for r in sharding.sharded(docs.repartition(n), ["doc_id"]).collect()} for n in (2, 7))
    assert a == b


def test_equal_null_and_hot_keys(spark):
    texts = ["same"] * 400 + [f"t {i}" for i in range(600)] + [None, "", "x" * 1_000_000]
    ids = [7] * 400 + [None] * 200 + list(range(400)) + [5, 5, 6]
    docs = make_docs(spark, texts, ids=ids)
    check(docs.collect(), sharding.sharded(docs, ["doc_id", "text"]).collect())


def test_a_hot_key_is_numbered_in_many_tasks(spark):
    rows = spark.range(20000).select(F.lit(3).alias("shard"), F.lit("k").alias("k"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sharding.slots(rows, "shard", ["k"], "slot")
        assert out.agg(F.min("slot"), F.max("slot"), F.countDistinct("slot")).first()[:] == (0, 19999, 20000)
        ranges = spark.read.parquet(next(p for p in reversed(_scratch(spark)) if "shard-ranges" in p)).groupBy("__part").count().collect()
        assert len(ranges) >= 6 and max(r["count"] for r in ranges) < 2 * 20000 / len(ranges)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def _scratch(spark):
    import os
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return sorted((f"{top}/{x}" for x in os.listdir(top)), key=os.path.getmtime)


def test_no_python_in_the_plan(spark, docs):
    plan = sharding.sharded(docs, ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_and_clashes(spark, no_docs, docs):
    assert sharding.sharded(no_docs, ["doc_id"]).count() == 0
    out = sharding.sharded(docs.withColumn("slot", F.lit("x")), ["doc_id", "size", "slot", "text"])
    assert out.columns[:4] == ["doc_id", "given_size", "given_slot", "text"]
    assert out.where("given_size = 2 and given_slot = 'x'").count() == docs.count()
