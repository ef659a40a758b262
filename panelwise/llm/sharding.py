"""Sharding by jump consistent hashing. DataFrame functions only.

A key's 64-bit hash seeds a pseudo-random walk of ever larger shard numbers:
b = 0 < b1 < b2 < ... The shard of n is the last number of the walk below n.
No ring table is kept, and with n + 1 shards a key either stays or goes to the
new shard n, which happens to one key in n + 1.

The 64-bit multiplication of the walk wraps around. Spark's integers do not,
so the state is kept as two halves of 32 bits and multiplied by halves of 16.
The walk has about ln(n) steps; ``STEPS`` are taken in any case and, for
a key that is not through by then, as many as there are shards.

Rows of a shard are numbered without gaps (``slots``) in the order of a hash of
their columns. That order is spread over tasks by ranges, whose bounds tell
even identical rows apart by their place in a written table. Counts per (range,
shard) give each range its first slot, so no shard is ever in one task.

Defined results: the key is the id's text, null like the empty text; equal keys
share a shard (that is the law: a key with a third of the rows makes a large
shard, spread over many tasks here). A null text has no bytes: size 1, crc32 0.
Rows equal in all columns that order a shard get different slots in any order.
Columns asked for keep their names; one named like a result is returned as
``given_<name>``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import returned_as, table, text_or_empty, written

SHARDS = 8
STEPS = 24
# The multiplier of the walk's generator is a fixed value of the method:
# 2862933555777941757, by halves of 32 bits, the lower one by halves of 16.
MULTIPLIER = 2862933555777941757
HIGH = MULTIPLIER >> 32
LOW_HIGH, LOW_LOW = (MULTIPLIER >> 16) & 0xFFFF, MULTIPLIER & 0xFFFF
MASK32 = 0xFFFFFFFF

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def key_halves(key: Column) -> tuple[Column, Column]:
    """The upper and lower 32 bits of a key's hash (md5 of its text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return half(1), half(9)


def _times(x: Column, high: int, low: int) -> Column:
    """x * (high * 2^16 + low) modulo 2^32, for x below 2^32."""
    return (x * _long(low) + F.shiftleft((x * _long(high)).bitwiseAND(_long(0xFFFF)), 16)).bitwiseAND(_long(MASK32))


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _step(s: Column) -> Column:
    """The walk's next state: the generator's next number gives the next jump."""
    cross = s["lo"] * _long(LOW_HIGH)
    lower = s["lo"] * _long(LOW_LOW) + F.shiftleft(cross.bitwiseAND(_long(0xFFFF)), 16) + _long(1)
    carry = F.shiftright(lower, 32) + F.shiftright(cross, 16)
    upper = (carry + _times(s["lo"], HIGH >> 16, HIGH & 0xFFFF) + _times(s["hi"], LOW_HIGH, LOW_LOW)).bitwiseAND(_long(MASK32))
    share = F.lit(2147483648.0) / (F.shiftright(upper, 1) + 1).cast("double")
    to = F.floor((s["j"] + 1).cast("double") * share).cast("long")
    return F.struct(s["j"].alias("b"), to.alias("j"), upper.alias("hi"), lower.bitwiseAND(_long(MASK32)).alias("lo"))


def jump(high: Column, low: Column, shards: int) -> Column:
    """struct(b, j, ...): the shard among ``shards`` and the first number of the
    key's walk that is not below ``shards``. ``j = shards`` means that one more
    shard takes the key."""
    walk = lambda s, _: F.when(s["j"] < shards, _step(s)).otherwise(s)
    begin = F.struct(_long(-1).alias("b"), _long(0).alias("j"), high.alias("hi"), low.alias("lo"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, STEPS))), begin, walk)
    if shards <= STEPS:  # every step goes at least one shard further
        return first
    rest = F.when(first["j"] < shards, F.sequence(F.lit(1), F.lit(shards))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rest, first, walk)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a key among ``shards``, as int."""
    return jump(*key_halves(key), shards)["b"].cast("int")


def slots(rows: DataFrame, shard: str, order: list[str], out: str) -> DataFrame:
    """``rows`` with the gapless number of each in its ``shard``, from 0, in
    the order of ``order``."""
    held = written(rows.withColumn("__at", F.monotonically_increasing_id()), "shard-rows")
    place = [F.col(c).asc_nulls_first() for c in order] + [F.col("__at").asc()]
    dealt = written(held.repartitionByRange(F.col(shard).asc(), *place).withColumn("__part", F.spark_partition_id()), "shard-ranges")
    counts = dealt.groupBy("__part", shard).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per (range, shard): as many as there are ranges.
    starts = counts.select(F.col("__part").alias("__p"), F.col(shard).alias("__s"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__part", shard).orderBy(*place)
    return (dealt.withColumn("__local", F.row_number().over(inside) - 1)
            .join(starts, (F.col("__part") == F.col("__p")) & (F.col(shard) == F.col("__s")))
            .withColumn(out, (F.col("__start") + F.col("__local")).cast("long"))
            .drop("__at", "__part", "__local", "__p", "__s", "__start"))


def sharded(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text",
            shards: int = SHARDS) -> DataFrame:
    """One row per document: ``columns``, size (UTF-8 bytes and one more),
    text_crc32, law ("key"), shard, slot, and grown_shard, the shard if there
    were one more. ``columns`` may hold any column of ``docs``, the text
    included; a shard's rows in slot order are its documents."""
    text = text_or_empty(text_col)
    walk = docs.select(
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias("__own"), F.col(id_col).cast("string").alias("__id"),
        (F.octet_length(text) + 1).cast("long").alias("__size"), F.crc32(text.cast("binary")).alias("__crc"),
        jump(*key_halves(F.col(id_col)), shards).alias("__walk"))
    rows = walk.select(
        "__own", "__id", "__size", "__crc", F.col("__walk")["b"].cast("int").alias("__shard"),
        F.when(F.col("__walk")["j"] == shards, F.lit(shards)).otherwise(F.col("__walk")["b"]).cast("int").alias("__grown"),
        F.md5(F.concat_ws("/", F.coalesce("__id", F.lit("")), F.col("__crc").cast("string"), F.col("__size").cast("string")).cast("binary")).alias("__place"))
    numbered = slots(rows, "__shard", ["__place", "__id", "__crc", "__size"], "__slot")
    own = [F.col("__own")[f"c{i}"].alias(c) for i, c in enumerate(returned_as(columns, RESULTS))]
    return numbered.select(*own, F.col("__size").alias("size"),
                           F.col("__crc").alias("text_crc32"), F.lit("key").alias("law"), F.col("__shard").alias("shard"),
                           F.col("__slot").alias("slot"), F.col("__grown").alias("grown_shard"))


def op13_jump_shards(spark, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), ["doc_id"])


def _crc_table() -> list[int]:
    """The 256 steps of crc32 for one byte, from its polynomial."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


# The walk as a recursive query in 128-bit integers; crc32 by folding a text's bytes.
SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS t FROM documents),
c AS (SELECT *, (strlen(t) + 1)::BIGINT AS size,
             xor(list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT),
                             lambda s, x: xor(list_extract({_crc_table()}, (xor(s, x) & 255) + 1), s >> 8), 4294967295::BIGINT), 4294967295) AS crc FROM d),
walk AS (SELECT rid, ('0x' || substr(md5(k), 1, 16))::UBIGINT::HUGEINT AS seed, -1::BIGINT AS b, 0::BIGINT AS j FROM d
         UNION ALL
         SELECT rid, next, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
         FROM (SELECT rid, j, (seed * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT AS next FROM walk WHERE j < {SHARDS})),
s AS (SELECT rid, b, j FROM walk WHERE j >= {SHARDS})
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, b::INTEGER AS shard,
       row_number() OVER (PARTITION BY b ORDER BY md5(k || '/' || crc || '/' || size), k, crc, size) - 1 AS slot,
       CASE WHEN j = {SHARDS} THEN {SHARDS} ELSE b END::INTEGER AS grown_shard
FROM c JOIN s USING (rid)
"""
