"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, twice in a row. A
document's virtual finish time is the source's words up to and including it,
divided by the source's target. Sorting all queued documents by that time and
cutting at the total budget takes from every source in proportion to its
target.

Both orders (inside a source and over all) are range sorts in two steps:
sums per bucket of the order, then a running sum inside each bucket. Buckets
number about the square root of the rows, so neither a hot source nor the
whole table meets in one task. A document's place is a hash of its id and text, so
rows of one (or no) id are spread; rows that agree in both are one entry with a
count in the orders, and are dealt out one by one only where their finish times matter.

Defined results: a null text has size 0; a null source is a source of its
own, last in order; documents without words are never queued (taken 0); rows
that agree in id, source and text follow each other in the queue and share what they win as
evenly as whole copies allow, in any order; a very long text is taken whole or not; other columns are
carried along under whatever names; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
SEED = "mix-1"
RUN = 10_000     # equal rows that one task deals out
GROUP = ["doc_id", "source", "spot", "tie"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: (source, source_size, target).

    Sources take ``weights`` in turn, by code point, null last. They share
    ``share`` times all words by weight; a target stops at ``max_repeat``
    times its source and the rest goes to the others by weight. That is
    target = min(cap, level * weight) with one level for all, found on the
    sources sorted by cap / weight.
    """
    by = Window.orderBy(F.col("source").asc_nulls_last())
    picks = F.array(*[F.lit(float(w)) for w in weights])
    s = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("w", F.element_at(picks, ((F.row_number().over(by) - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * float(max_repeat)))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0.0)
    level = ((F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), zero))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero)))
    s = s.withColumn("own_level", level)
    fits = F.when(F.col("own_level") <= F.col("cap") / F.col("w"), F.col("own_level"))
    # The first source, in order, that its level leaves below its cap sets the
    # level; sources before it are capped. None: every source is capped.
    s = s.withColumn("level", F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return s.select("source", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def running_sum(df: DataFrame, value: str, out: str, keys: list[str], bucket: str, order: list) -> DataFrame:
    """Running sum of ``value`` in ``order`` within ``keys``; ``bucket`` is a
    column that grows with the order."""
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    # A bucket holds about sqrt(rows) rows, and a key about sqrt(rows) buckets.
    starts = sums.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(bucket).alias("__bucket"),
                         F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__start"))
    on = F.col(bucket) == F.col("__bucket")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("__local", F.sum(value).over(inside))
    return (local.join(starts, on, "left")
            .withColumn(out, F.col("__start") + F.col("__local"))
            .drop("__start", "__local", "__bucket", *[f"__{k}" for k in keys]))


def queue_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, spot, tie): spot is the shuffled place of a
    document in its source, a hash of its id and text; tie is the text's digest."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
                       F.md5(F.coalesce(text, F.lit(""))).alias("tie")).select(
        "doc_id", "source", "size", _spot(seed).alias("spot"), "tie")


def _spot(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.col("tie")))


def each_twin(groups: DataFrame, name: str = "nth") -> DataFrame:
    """One row per document of every group (``twins`` of them), numbered from
    0. Large groups are cut into runs that are spread before they are dealt out."""
    few = groups.where(F.col("twins") <= RUN).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("twins") - 1)))
    many = groups.where(F.col("twins") > RUN).withColumn("__first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("twins") - 1, F.lit(RUN).cast("long"))))
    spread = many.repartition(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    many = spread.withColumn(name, F.explode(F.sequence("__first", F.least(F.col("__first") + (RUN - 1), F.col("twins") - 1))))
    return few.unionByName(many.drop("__first"))


def group_copies(queued: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """From :func:`queue_positions` (as a written table): one row per group of
    equal documents with size, source_size, target, ``twins`` (documents) and
    ``won`` (times taken, all twins together)."""
    n = queued.count()
    parts = max(1, math.isqrt(n))
    span = max(1, math.ceil(16 ** 6 / parts))
    targets = source_targets(queued, weights, share, max_repeat)
    q = queued.groupBy(*GROUP).agg(F.max("size").alias("size"), F.count("*").alias("twins"))
    q = q.withColumn("words", F.col("size") * F.col("twins"))
    q = q.withColumn("slot", F.floor(F.conv(F.substring("spot", 1, 6), 16, 10).cast("long") / span))
    q = running_sum(q, "words", "done", ["source"], "slot", ["spot", "doc_id", "tie"])
    targets = targets.withColumnRenamed("source", "__s")
    q = q.join(targets, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s", "slot")
    q = written(q.withColumn("before", F.col("done") - F.col("words")).drop("done", "words"), "mix-groups")
    # Virtual finish times of every turn a document has in its source's queue.
    turns = (each_twin(q.where("size > 0")).withColumn("done", F.col("before") + (F.col("nth") + 1) * F.col("size"))
             .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
             .withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("done")) / F.col("target"))
             .withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(float(max_repeat + 1))) * parts)))
    budget = queued.agg((F.sum("size") * F.lit(share)).alias("budget")).first()["budget"] or 0.0
    # The bucket where the sorted running total crosses the budget: earlier
    # ones are taken whole, and only its own rows need their order.
    slots = turns.groupBy("slot").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    cut = (slots.withColumn("upto", upto).where(F.col("upto") > budget).orderBy("slot")
           .select("slot", (F.col("upto") - F.col("words")).alias("before")).limit(1).collect())
    if cut:
        slot, before = cut[0]["slot"], cut[0]["before"]
        order = Window.partitionBy("slot").orderBy("finish", F.col("source").asc_nulls_last(), "spot", "doc_id", "tie", "turn")
        last = (turns.where(F.col("slot") == slot)
                .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(before))
                .where(F.col("upto") <= budget).drop("upto"))
        taken = turns.where(F.col("slot") < slot).unionByName(last)
    else:
        taken = turns
    won = taken.groupBy(*GROUP).agg(F.count("*").alias("won"))
    won = won.select(*[F.col(c).alias(f"__{c}") for c in GROUP], "won")
    out = q.join(won, _same_group(), "left").drop(*[f"__{c}" for c in GROUP])
    return out.select(*GROUP, "size", "source_size", "target", "twins", F.coalesce("won", F.lit(0)).alias("won"))


def _same_group() -> Column:
    same = F.lit(True)
    for c in GROUP:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return same


def _own_copies(nth: str) -> Column:
    """What twin number ``nth`` gets of its group's copies."""
    return (F.floor(F.col("won") / F.col("twins")) + F.when(F.col(nth) < F.col("won") % F.col("twins"), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, spot, tie, size, source_size, target, copies."""
    queued = written(queue_positions(docs, id_col, text_col, source_col, seed), "mix-queue")
    groups = written(group_copies(queued, weights, share, max_repeat), "mix-won")
    return each_twin(groups).select(*GROUP, "size", "source_size", "target", _own_copies("nth").alias("copies"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", seed: str = SEED, **kw) -> DataFrame:
    """The documents of the mix, a document taken twice appearing twice: as
    many words as the mix takes. Columns as in ``docs``; documents without words stay (they cost nothing).

    Documents are written once under a row number, which meets the copies
    won. Only in groups whose twins do not all get the same are rows ranked, by
    partition of that table and with the counts of earlier partitions."""
    text = F.col(text_col)
    held = written(docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"), F.col(id_col).alias("doc_id"),
                               F.col(source_col).alias("source"), word_count(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias("tie"),
                               F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part")), "mix-documents")
    queued = held.select("doc_id", "source", "size", _spot(seed).alias("spot"), "tie", "at", "part")
    groups = group_copies(queued.drop("at", "part"), **kw).select(*[F.col(c).alias(f"__{c}") for c in GROUP], "twins", "won")
    rows = written(queued.join(groups, _same_group()).select(*GROUP, "size", "at", "part", "twins", "won"), "mix-rows")
    uneven = F.col("won") % F.col("twins") != 0
    even = rows.where(~uneven).withColumn("nth", F.lit(0).cast("long"))
    odd = rows.where(uneven)
    order = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = odd.groupBy(*GROUP, "part").count().withColumn("start", F.coalesce(F.sum("count").over(order), F.lit(0)))
    starts = starts.select(*[F.col(c).alias(f"__{c}") for c in GROUP], F.col("part").alias("__part"), "start")
    ranked = (odd.withColumn("local", F.row_number().over(Window.partitionBy(*GROUP, "part").orderBy("at")) - 1)
              .join(starts, _same_group() & (F.col("part") == F.col("__part"))).withColumn("nth", F.col("start") + F.col("local")))
    copies = F.when(F.col("size") == 0, 1).otherwise(_own_copies("nth"))
    chosen = even.select("at", copies.alias("n")).unionByName(ranked.select("at", copies.alias("n"))).where("n > 0")
    chosen = chosen.withColumnRenamed("at", "__at")
    return (held.join(chosen, F.col("at") == F.col("__at")).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)]))


def op4_weighted_fair_mix(spark, sf_dir: str) -> DataFrame:
    from .common import table
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


# Literal numbers are the parameters above.
SQL = r"""
WITH q AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1' || coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))) AS spot, md5(coalesce(text, '')) AS tie
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM q GROUP BY source),
s1 AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
              source_size * 2.0::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                  - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv
       FROM s1),
s3 AS (SELECT *, first_value(CASE WHEN lv <= cap / w THEN lv END IGNORE NULLS)
                 OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS level
       FROM s2),
t AS (SELECT source, source_size, coalesce(least(cap, level * w), cap) AS target FROM s3),
d AS (SELECT q.*, t.source_size, t.target,
             sum(size) OVER (PARTITION BY q.source ORDER BY spot, doc_id, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source),
u AS (SELECT d.*, turn, (turn * source_size + done)::DOUBLE / target AS finish FROM d, (VALUES (0), (1)) v(turn) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, spot, doc_id, tie, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM u),
k AS (SELECT doc_id, source, tie, count(*) AS copies FROM r WHERE upto <= (SELECT sum(size) * 1.5::DOUBLE FROM q) GROUP BY ALL)
SELECT d.doc_id, d.size, d.source_size, d.target, (d.size * coalesce(k.copies, 0))::BIGINT AS taken
FROM d LEFT JOIN k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.source IS NOT DISTINCT FROM k.source AND d.tie = k.tie
"""
