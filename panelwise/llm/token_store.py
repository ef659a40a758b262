"""Token-id files with a minimal perfect hash index.

Format: a folder with three Parquet tables, so that any store that Spark
reads and writes can hold it.

* ``shards``, a folder per part: (part, seq, first long, payload binary, docs). Payload: raw
  token ids of consecutive documents, little-endian unsigned 32-bit, in
  ascending key order; ``first`` counts the ids of earlier shards of the part;
  docs lists (key, at, n), a document's place and count of ids in the payload.
* ``parts``: (part, base long, shards int, buckets int): ids in all earlier parts.
* ``index``: (bucket, sizes, levels, prints, slots): for a bucket of keys, a
  minimal perfect hash (a cascade of bit arrays: a key settles at the first
  level where it is alone in its slot; its number is the rank of that bit),
  and at that number the key's 32-bit fingerprint and the span of its
  documents, which follow each other: part and seq of the first and of the
  last shard with the key.

A keyed read hashes the key to its bucket, finds its number, compares the
fingerprint and opens the shards of the span, usually one: constant time a key. Only
the folders of their parts are read. A key that is not
stored passes the fingerprint with a chance of 2^-32; the shard's own list of
keys, read with the payload, then refuses it.

Defined results: a null key sorts first and is stored, but keyed reads find
only non-null keys (``read_documents`` scans for the others); rows with the same key are all stored and
all found, however many shards they fill; rows equal in key and text are stored next to
each other by the same task; a null or empty text has only its end id;
an empty table gives empty files. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import batches_of, scratch, ship, small_batches, table, text_bytes, text_or_empty, written
from .tokens import byte_bpe, tokenizer_path

ship(__name__)

SHARD_BYTES = 4 << 20   # payload of a shard, unless one document is longer
PART_BYTES = 32 << 20   # text per part (a range of keys), at least
MAX_PARTS = 20_000      # parts; the table of their bases, one row each, is collected and broadcast
BUCKET_KEYS = 20_000    # keys per bucket of the index
END_ID = 0
LEVELS = 48
GAMMA = 2.0             # bits per key at each level

DOCS = "array<struct<key: bigint, at: bigint, n: bigint>>"
SHARDS = f"part int, seq int, first long, n long, payload binary, docs {DOCS}"
PARTS = "part int, base long, shards int, buckets int"
SLOT = [("part", "<i4"), ("seq", "<i4"), ("last_part", "<i4"), ("last_seq", "<i4")]
SPAN = "key long, part int, seq int, last_part int, last_seq int"


def _mixed(keys, seed: int):
    """64-bit hash of int64 keys (splitmix64 of key and seed)."""
    import numpy as np
    u = np.uint64
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(u) + u((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
        x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
        return x ^ (x >> u(31))


def build_hash(keys):
    """Levels of a minimal perfect hash of distinct int64 keys: a list of
    (bits, packed bytes). Keys alone in their slot settle, others go on."""
    import numpy as np
    levels, rest = [], keys
    for level in range(LEVELS):
        if not len(rest):
            break
        m = max(64, int(len(rest) * GAMMA) + 1)
        slot = (_mixed(rest, level + 1) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(slot, minlength=m) == 1
        levels.append((m, np.packbits(alone, bitorder="little")))
        rest = rest[~alone[slot]]
    if len(rest):
        raise ValueError("keys of a bucket must be distinct")
    return levels


def hash_numbers(levels, keys):
    """The number of each key, -1 where no level holds it. Exact for the keys
    that the hash was built from; others get any number or -1."""
    import numpy as np
    out = np.full(len(keys), -1, dtype=np.int64)
    todo = np.arange(len(keys))
    base = 0
    for level, (m, packed) in enumerate(levels):
        bits = np.unpackbits(packed, count=m, bitorder="little")
        rank = np.cumsum(bits) - bits
        slot = (_mixed(keys[todo], level + 1) % np.uint64(m)).astype(np.int64)
        hit = bits[slot] == 1
        out[todo[hit]] = base + rank[slot[hit]]
        todo = todo[~hit]
        base += int(bits.sum())
    return out


def _fingerprints(keys):
    import numpy as np
    return (_mixed(keys, 1_000_003) >> np.uint64(32)).astype("<u4")


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, shard_bytes: int = SHARD_BYTES, bucket_keys: int = BUCKET_KEYS,
                 part_bytes: int = PART_BYTES) -> None:
    """Encode every document and write shards, parts and index under ``path``."""
    spark = docs.sparkSession
    small_batches(spark)
    tok = tokenizer or tokenizer_path()
    total, rows = docs.select(text_bytes(text_col).alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0)), F.count("*")).first()
    n_parts = max(1, min(-(-total // part_bytes), MAX_PARTS))
    buckets = max(1, -(-rows // bucket_keys))

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        enc = byte_bpe(tok)
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], dtype="<u4").tobytes()
        seq = first = size = 0
        held, docs_of = [], []
        kind = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int64()), ("n", pa.int64())]))

        def shard():
            nonlocal seq, first, size
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([b"".join(held)], pa.binary()), pa.array([docs_of], kind)],
                ["part", "seq", "first", "n", "payload", "docs"])
            seq, first, size = seq + 1, first + size, 0
            held.clear()
            docs_of.clear()
            return out

        for b in batches:
            key, text = b.column(0), b.column(1)
            for s, e in batches_of(text, 2 << 20):
                for k, ids in zip(key.slice(s, e - s).to_pylist(), enc.encode(text.slice(s, e - s))):
                    n = len(ids) // 4 + 1
                    held += (ids, end)
                    docs_of.append({"key": k, "at": size, "n": n})
                    size += n
                    if size * 4 >= shard_bytes:
                        yield shard()
        if docs_of:
            yield shard()

    # The hash of the text settles equal keys and splits a very common one.
    order = [F.col("key").asc_nulls_first(), F.col("tie"), F.col("text")]
    (docs.select(F.col(id_col).cast("long").alias("key"), text_or_empty(text_col).alias("text"))
     .withColumn("tie", F.xxhash64("text"))
     .repartitionByRange(n_parts, *order[:2]).sortWithinPartitions(*order)
     .select("key", "text").mapInArrow(encode, SHARDS)
     .write.partitionBy("part").option("compression", "zstd").parquet(f"{path}/shards"))

    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    # One row per part: at most MAX_PARTS.
    base, bases = 0, []
    for r in shards.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("shards")).orderBy("part").collect():
        bases.append((r["part"], base, r["shards"], buckets))
        base += r["n"]
    spark.createDataFrame(bases, PARTS).coalesce(1).write.parquet(f"{path}/parts")

    def index(bucket, tbl):
        import numpy as np
        import pyarrow as pa
        k = tbl.column("key").to_numpy()
        levels = build_hash(k)
        back = np.empty(len(k), dtype=np.int64)
        back[hash_numbers(levels, k)] = np.arange(len(k))
        slots = np.zeros(len(k), dtype=np.dtype(SLOT))
        for c, _ in SLOT:
            slots[c] = tbl.column(c).to_numpy()[back]
        return pa.table({
            "bucket": pa.array([bucket[0].as_py()], pa.int64()),
            "sizes": pa.array([[m for m, _ in levels]], pa.list_(pa.int64())),
            "levels": pa.array([[p.tobytes() for _, p in levels]], pa.list_(pa.binary())),
            "prints": pa.array([_fingerprints(k[back]).tobytes()], pa.binary()),
            "slots": pa.array([slots.tobytes()], pa.binary())})

    shard = F.struct("part", "seq")
    (shards.select("part", "seq", F.explode("docs.key").alias("key")).where("key IS NOT NULL")
     .groupBy("key").agg(F.min(shard).alias("a"), F.max(shard).alias("z"))
     .select("key", "a.*", F.col("z.part").alias("last_part"), F.col("z.seq").alias("last_seq"), F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
     .groupBy("bucket")
     .applyInArrow(index, "bucket long, sizes array<long>, levels array<binary>, prints binary, slots binary")
     .write.parquet(f"{path}/index"))


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema(SHARDS).parquet(f"{path}/shards"), spark.read.schema(PARTS).parquet(f"{path}/parts"))


def _sliced(shards: DataFrame, parts: DataFrame) -> DataFrame:
    """Every document of the shards, sliced from the payloads: part, seq, key,
    start (ids of all documents before it), n, ids binary."""
    # ``parts`` has at most MAX_PARTS rows of 20 bytes.
    docs = shards.join(F.broadcast(parts.select("part", "base")), "part").select("part", "seq", "payload", (F.col("base") + F.col("first")).alias("before"), F.explode("docs").alias("d"))
    return docs.select("part", "seq", "d.key", (F.col("before") + F.col("d.at")).alias("start"), "d.n",
                       F.expr("substring(payload, int(d.at * 4 + 1), int(d.n * 4))").alias("ids"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every stored document by a scan: key, start, n, ids binary."""
    return _sliced(*_opened(spark, path)).drop("part", "seq")


def spans(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Where the index says that the distinct keys of ``keys`` are: key and,
    per shard of its span, part and seq. A written table."""
    _, parts = _opened(spark, path)
    index = spark.read.parquet(f"{path}/index")
    buckets = (parts.agg(F.max("buckets")).first()[0] or 1)
    wanted = (keys.where(F.col(key_col).isNotNull()).select(F.col(key_col).cast("long").alias("key")).distinct()
              .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))))

    def find(key, left, right):
        import numpy as np
        import pyarrow as pa
        kinds = [("key", pa.int64()), *[(c, pa.int32()) for c, _ in SLOT]]
        ks = left.column("key").to_numpy()
        if not len(ks) or not right.num_rows:
            return pa.table({c: pa.array([], k) for c, k in kinds})
        row = right.slice(0, 1).to_pylist()[0]
        levels = [(m, np.frombuffer(p, dtype=np.uint8)) for m, p in zip(row["sizes"], row["levels"])]
        prints = np.frombuffer(row["prints"], dtype="<u4")
        slots = np.frombuffer(row["slots"], dtype=np.dtype(SLOT))
        at = hash_numbers(levels, ks)
        ok = at >= 0
        ok[ok] = prints[at[ok]] == _fingerprints(ks[ok])
        got = slots[at[ok]]
        return pa.table({"key": pa.array(ks[ok], pa.int64()),
                         **{c: pa.array(np.ascontiguousarray(got[c]), k) for c, k in kinds[1:]}})

    places = wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, SPAN)
    # A span covers its first part from seq on, its last part up to last_seq and all between.
    each = places.withColumn("p", F.explode(F.sequence("part", "last_part")))
    each = each.join(F.broadcast(parts.select(F.col("part").alias("q"), "shards")), F.col("p") == F.col("q"))
    first = F.when(F.col("p") == F.col("part"), F.col("seq")).otherwise(0)
    last = F.when(F.col("p") == F.col("last_part"), F.col("last_seq")).otherwise(F.col("shards") - 1)
    return written(each.select("key", F.col("p").alias("part"), F.explode(F.sequence(first, last)).alias("seq")), "spans")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Keyed reads through the index: every document whose key is among the
    distinct keys of ``keys``: key, start, n, ids binary. Only the folders of the
    parts that the index names are read."""
    shards, parts = _opened(spark, path)
    places = spans(spark, path, keys, key_col)
    named = [r[0] for r in places.select("part").distinct().collect()]  # at most MAX_PARTS
    asked = places.select(F.col("key").alias("k"), F.col("part").alias("p"), F.col("seq").alias("s"))
    on = (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s"))
    return _sliced(shards.where(F.col("part").isin(named)), parts).join(asked, on).select("key", "start", "n", "ids")


def indexed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every stored document with a digest instead of its ids: key, start, n,
    ids_crc32. Documents with a key are those that the index leads to; those without are found by a scan."""
    shards, parts = _opened(spark, path)
    docs = _sliced(shards, parts).select("part", "seq", "key", "start", "n", F.crc32("ids").alias("ids_crc32"))
    places = spans(spark, path, shards.select(F.explode("docs.key").alias("key")))
    asked = places.select(F.col("key").alias("k"), F.col("part").alias("p"), F.col("seq").alias("s"))
    on = (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s"))
    return docs.where("key IS NOT NULL").join(asked, on).select("key", "start", "n", "ids_crc32").unionByName(
        docs.where("key IS NULL").select("key", "start", "n", "ids_crc32"))


def op2_token_store(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-store")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return indexed_documents(spark, path).select(F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), "ids_crc32")
