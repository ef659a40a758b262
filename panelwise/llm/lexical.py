"""Ranked lexical search by pipelined term partitioning.

The index is owned by terms: a posting row holds one term's documents in one
chunk of documents. Terms are dealt to owner stages by how many documents hold
them, rare ones first. Items travel in bundles: a bundle starts with an empty
accumulator for every chunk and goes through the stages one after the other;
at each it meets, by cogroup, the postings of its terms that the stage owns, adds
integer contributions to its (item, document) scores and carries the sparse
result on. After the last stage every group of chunks sends its best documents of
each item, and a window selects the best of all.

Bounds: a chunk has at most ``CHUNK_DOCS`` documents or ``CHUNK_BYTES`` of text (one document
at least), a bundle at most ``BUNDLE_ITEMS`` items, so an accumulator has at
most their product, whatever the terms. A term that every document holds is
one row per chunk; rows meet their term's weight under a salt, and then go by
(bundle, group of chunks). Texts are read once and never shuffled. The items'
terms travel to the tasks that read texts only up to ``MAX_TERMS`` of them (and
``MAX_TERM_BYTES``); beyond that the postings of all terms are made, with
the same result.

A document's contribution of a term is w * (10^9 tf div (1000 tf + 12 m)), with
w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 75 + 25 n N div L.

Terms are maximal runs of ASCII letters and digits and of all characters from
U+0080 on, A-Z in lower case.

Defined results: a null or empty text (of a document or an item) has no terms;
documents without terms count nowhere; items without a hit have no rows; rows
with equal or null ids are documents and items of their own, equal scores go by
ascending doc_id, null last, then in any order; empty tables give an empty result.
Other columns are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from .common import ship, small_batches, table, text_or_empty, written

ship(__name__)

TOP = 20
CHUNK_DOCS = 4096        # at most 65,536: places in a chunk have 16 bits
CHUNK_BYTES = 8 << 20
GROUP_DOCS = 16384       # documents that a task of a stage has on average
BUNDLE_ITEMS = 256
RARE = (1000, 100)       # stage borders: in at most one document of so many
SALT = 32
MAX_TERMS, MAX_TERM_BYTES = 1_000_000, 32 << 20

POSTINGS = "chunk long, term binary, df long, docs binary, tfs binary, tokens long"
STATE = "bundle long, grp long, chunk long, n binary, ids binary, at binary, score binary"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(TERM_BYTES).split()


# Letters of a term as they are, A-Z in lower case, everything else a space.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def packed(x):
    """Counts as one byte each if they fit, else four; ``unpacked`` tells by the length."""
    return x.astype("u1" if not len(x) or x.max() < 256 else "<u4").tobytes()


def unpacked(raw: bytes, n: int):
    import numpy as np
    return np.frombuffer(raw, dtype="u1" if len(raw) == n else "<u4").astype(np.int64)


def as_ipc(column) -> bytes:
    """An Arrow column of any type as bytes."""
    import pyarrow as pa
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([column], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(raw: bytes):
    import pyarrow as pa
    return pa.ipc.open_stream(raw).read_all().column(0).combine_chunks()


class Chunk:
    """Documents read so far and their postings."""

    def __init__(self, number: int):
        self.number, self.ids, self.n, self.bytes, self.postings = number, [], [], 0, {}

    def add(self, words: list[bytes], size: int, known) -> None:
        from collections import Counter
        at = len(self.n)
        self.n.append(len(words))
        self.bytes += size
        for term, tf in Counter(words if known is None else filter(known.__contains__, words)).items():
            p = self.postings.get(term)
            if p is None:
                self.postings[term] = p = ([], [])
            p[0].append(at)
            p[1].append(tf)

    def batch(self):
        """Its rows: one per term, and one with lengths and ids. Places are
        numbered in the order of the ids."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        ids = pa.chunked_array(self.ids).combine_chunks()
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        rows = []
        for term, (docs, tfs) in self.postings.items():
            at = place[docs]
            by = np.argsort(at)
            rows.append((self.number, term, len(docs), at[by].astype("<u2").tobytes(), packed(np.array(tfs)[by]), 0))
        n = np.array(self.n, dtype=np.int64)
        rows.append((self.number, None, int((n > 0).sum()), n[order].astype("<u4").tobytes(), as_ipc(ids.take(pa.array(order))), int(n.sum())))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                                          names=["chunk", "term", "df", "docs", "tfs", "tokens"])


def postings(docs: DataFrame, known: set | None, id_col: str, text_col: str,
             chunk_docs: int = CHUNK_DOCS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The index of the terms in ``known`` (None: of all), as a written table:
    per chunk and term the documents (places in the chunk) and how often each holds
    it; per chunk, under a null term, the documents' lengths and ids."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(known) if known is not None else None  # at most MAX_TERMS

    def index(batches):
        wanted = held.value if held is not None else None
        chunk = None
        for b in batches:
            numbers, ids, texts = b.column(0).to_pylist(), b.column(1), b.column(2)
            first = 0
            for i, number in enumerate(numbers):
                if chunk is None:
                    chunk, first = Chunk(number), i
                text = texts[i].as_py().encode()
                chunk.add(terms_of(text), len(text), wanted)
                if len(chunk.n) >= chunk_docs or chunk.bytes >= chunk_bytes:
                    chunk.ids.append(ids.slice(first, i + 1 - first))
                    yield chunk.batch()
                    chunk = None
            if chunk is not None:
                chunk.ids.append(ids.slice(first))
        if chunk is not None:
            yield chunk.batch()

    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    return written(rows.mapInArrow(index, POSTINGS), "postings")


def bundles(items: DataFrame, id_col: str, text_col: str, size: int = BUNDLE_ITEMS) -> DataFrame:
    """Items in bundles of at most ``size``, as a written table: bundle, local
    (the number in the bundle), item_id, terms array<struct<term, times>>."""
    import pyarrow as pa
    n = max(1, math.ceil(items.count() / size))
    held = items.select(F.col(id_col).alias("item_id"), text_or_empty(text_col).alias("t")).repartition(n)
    held = held.select(F.monotonically_increasing_id().alias("at"), "item_id", "t")
    kind = pa.list_(pa.struct([("term", pa.binary()), ("times", pa.int64())]))

    def cut(batches):
        from collections import Counter
        done, bundle = 0, None
        for b in batches:
            at, texts = b.column(0).to_pylist(), b.column(2).to_pylist()
            where = []
            for a in at:
                if done % size == 0:
                    bundle = a
                where.append((bundle, done % size))
                done += 1
            terms = [[{"term": t, "times": k} for t, k in Counter(terms_of(x.encode())).items()] for x in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[0] for w in where], pa.int64()), pa.array([w[1] for w in where], pa.int64()), b.column(1), pa.array(terms, kind)],
                names=["bundle", "local", "item_id", "terms"])

    schema = StructType([*StructType.fromDDL("bundle long, local long").fields, StructField("item_id", items.schema[id_col].dataType),
                         *StructType.fromDDL("terms array<struct<term: binary, times: bigint>>").fields])
    return written(held.mapInArrow(cut, schema), "items")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id",
           text_col: str = "text", max_terms: int = MAX_TERMS, chunk_docs: int = CHUNK_DOCS, chunk_bytes: int = CHUNK_BYTES,
           group_docs: int = GROUP_DOCS, bundle_items: int = BUNDLE_ITEMS, rare=RARE) -> DataFrame:
    """The ``top`` best documents with a positive score of each item: item_id,
    rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    asked = bundles(items, item_id, text_col, bundle_items)
    wanted = asked.select("bundle", "local", F.inline("terms"))
    distinct = wanted.select("term").distinct()
    size = distinct.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("b")).first()
    known = {bytes(r[0]) for r in distinct.toLocalIterator()} if size["n"] <= max_terms and size["b"] <= MAX_TERM_BYTES else None
    index = postings(docs, known, doc_id, text_col, chunk_docs, chunk_bytes)
    chunks, terms = index.where("term is null"), index.where("term is not null")
    total = chunks.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("l"), F.count("*").alias("chunks")).first()
    n_docs, n_tokens = int(total["n"]), int(total["l"])
    groups = max(1, min(total["chunks"], math.ceil(n_docs / group_docs)))
    group = F.pmod(F.xxhash64("chunk"), F.lit(groups))

    # Each term's weight and stage, and per bundle the items that ask for it.
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    stage = F.lit(len(rare))
    for k in reversed(range(len(rare))):
        stage = F.when(F.col("df") * rare[k] <= n_docs, F.lit(k)).otherwise(stage)
    weights = terms.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("w"), stage.alias("stage")).where("w > 0")
    owned = written(
        wanted.join(weights, "term").groupBy("bundle", "term", "stage")
        .agg(F.collect_list(F.struct("local", (F.col("w") * F.col("times")).alias("gain"))).alias("of"))  # at most bundle_items
        .select("bundle", "stage", F.col("term").alias("t"), F.transform("of", lambda x: x["local"]).alias("local"),
                F.transform("of", lambda x: x["gain"]).alias("gain")), "owned")
    # A frequent term has a row in every chunk: salted, so that no task gets them all.
    salted = owned.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    met = (terms.withColumn("s", F.pmod(F.xxhash64("chunk"), F.lit(SALT)))
           .join(salted, (F.col("term") == F.col("t")) & (F.col("s") == F.col("salt")))
           .select("bundle", group.alias("grp"), "stage", *[F.col(c).alias(c) for c in ("chunk", "docs", "tfs", "local", "gain")]))

    def meet(carried, offered):
        """Per chunk of a group: its row of the state, and the accumulator
        after adding what the stage's postings contribute."""
        import numpy as np
        by_chunk = {}
        for r in zip(*[offered.column(c) for c in ("chunk", "docs", "tfs", "local", "gain")]):
            by_chunk.setdefault(r[0].as_py(), []).append(r[1:])
        for r in carried.to_pylist():
            n = np.frombuffer(r["n"], dtype="<u4")
            m = np.array([75 + 25 * x * n_docs // n_tokens for x in n.tolist()], dtype=np.int64)
            at, score = np.frombuffer(r["at"], dtype="<u4"), np.frombuffer(r["score"], dtype="<i8")
            found = by_chunk.pop(r["chunk"], [])
            top_item = max([int(at[-1] >> 16) if len(at) else 0, *[max(x[2].as_py()) for x in found]])
            acc = np.zeros((top_item + 1, len(n)), dtype=np.int64)
            acc[at >> 16, at & 0xFFFF] = score
            for docs_, tfs, local, gain in found:
                d = np.frombuffer(docs_.as_buffer(), dtype="<u2")
                tf = unpacked(tfs.as_py(), len(d))
                part = (1_000_000_000 * tf) // (1000 * tf + 12 * m[d])
                for i, g in zip(local.as_py(), gain.as_py()):
                    acc[i, d] += g * part
            yield r, acc

    def carry(key, carried, offered):
        import numpy as np
        import pyarrow as pa
        out = []
        for r, acc in meet(carried, offered):
            i, d = np.nonzero(acc)
            out.append({**r, "at": ((i << 16) | d).astype("<u4").tobytes(), "score": acc[i, d].astype("<i8").tobytes()})
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("bundle", pa.int64()), ("grp", pa.int64()), ("chunk", pa.int64()),
            *[(c, pa.binary()) for c in ("n", "ids", "at", "score")]]))

    def select(key, carried, offered):
        """The group's best documents of each item; equal scores by place, which
        is the order of ids inside a chunk, and by id between chunks."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        local, ids, score, nr = [], [], [], 0
        empty = None
        for r, acc in meet(carried, offered):
            own = from_ipc(r["ids"])
            empty = own.slice(0, 0)
            for i in range(len(acc)):
                hit = np.flatnonzero(acc[i])
                if len(hit) > top:
                    s = acc[i, hit]
                    least = np.partition(s, len(s) - top)[len(s) - top]
                    hit = hit[s >= least]
                best = hit[np.argsort(-acc[i, hit], kind="stable")][:top]
                if len(best):
                    local.append(np.full(len(best), i))
                    ids.append(own.take(pa.array(best)))
                    score.append(acc[i, best])
                    nr += len(best)
        if not nr:
            return pa.table({"bundle": pa.array([], pa.int64()), "local": pa.array([], pa.int64()),
                             "doc_id": empty if empty is not None else pa.array([], pa.null()), "score": pa.array([], pa.int64())})
        t = pa.table({"bundle": pa.array(np.full(nr, key[0].as_py())), "local": pa.array(np.concatenate(local)),
                      "doc_id": pa.chunked_array(ids), "score": pa.array(np.concatenate(score))})
        t = t.take(pc.sort_indices(t, sort_keys=[("local", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end"))
        i = t.column("local").to_numpy()
        nth = np.arange(nr) - np.searchsorted(i, i)
        return t.filter(pa.array(nth < top))

    # Every bundle starts at every chunk: one row each, the lengths and ids of the
    # chunk's documents beside an empty accumulator. Numbers of bundles: one per bundle_items items.
    who = ", ".join(f"{r[0]}L" for r in asked.select("bundle").distinct().collect())
    state = (chunks.where("df > 0").withColumn("bundle", F.explode(F.expr(f"cast(array({who}) as array<bigint>)")))
             .select("bundle", group.alias("grp"), F.col("chunk").alias("chunk"), F.col("docs").alias("n"), F.col("tfs").alias("ids"),
                     F.lit(b"").alias("at"), F.lit(b"").alias("score")))
    best = StructType([*StructType.fromDDL("bundle long, local long").fields, StructField("doc_id", docs.schema[doc_id].dataType),
                       *StructType.fromDDL("score long").fields])
    for k in range(len(rare) + 1):
        here = met.where(F.col("stage") == k).groupBy("bundle", "grp")
        last = k == len(rare)
        state = state.groupBy("bundle", "grp").cogroup(here).applyInArrow(select if last else carry, best if last else STATE)
    order = Window.partitionBy("bundle", "local").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select(F.col("bundle").alias("b"), F.col("local").alias("l"), "item_id")
    return (found.join(names, (F.col("bundle") == F.col("b")) & (F.col("local") == F.col("l")))
            .select("item_id", "rank", "doc_id", "score"))


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
n AS (SELECT rid, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*)::BIGINT AS docs, coalesce(sum(n), 0)::BIGINT AS tokens FROM n),
p AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000.0::DOUBLE * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM p, g GROUP BY term, docs),
i AS (SELECT iid, item_id, unnest(ts) AS term
      FROM (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark)),
s AS (SELECT iid, item_id, n.rid, n.doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // tokens))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN w USING (term) JOIN n ON n.rid = p.rid, g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
