"""Documents in blocks, and questions about keys that many blocks share.

A block is a hash share of the documents with a bounded amount of text. A task
works on a block's whole texts with arrays. What it needs from all other blocks
(a key's total count, or a value computed from totals) it asks for as sorted
distinct 64-bit keys, cut into parts by the keys' value: one row per block and
part. A part's task sees each key once per block, whatever its count, so no
key is hot, and answers every block in the order of its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import ship, text_bytes, text_or_empty

ship(__name__)

ASKED = "block long, part long, keys binary, seen binary, more binary"


def in_blocks(docs: DataFrame, columns: list, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int, int]:
    """(held, blocks, wide): documents as (__id, __text binary, __c0, __c1, ...,
    block), dealt by block over ``wide`` partitions."""
    spark = docs.sparkSession
    total = docs.select(text_bytes(text_col).alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    # No fewer partitions than Spark would make for the other side of a join by
    # block: then that side follows this one and the texts move once.
    wide = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = (docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"),
                        *[c.alias(f"__c{i}") for i, c in enumerate(columns)])
            .withColumn("block", F.pmod(F.xxhash64("__id", "__text"), F.lit(n)))
            .withColumn("__text", F.encode("__text", "UTF-8")).repartition(wide, "block"))
    return held, n, wide


def ordered(tbl):
    """A block's rows in an order that does not depend on the shuffle."""
    return tbl.sort_by([("__id", "ascending"), ("__text", "ascending")]).combine_chunks()


def cut_by_part(keys, n: int):
    """Ranges of sorted uint64 ``keys`` by equal spans of their values: (part, from, to)."""
    import numpy as np
    part = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(keys) else []
    for s, e in zip(first, [*first[1:], len(keys)]):
        yield int(part[s]), int(s), int(e)


def packed(x) -> bytes:
    """Whole numbers as byte planes (all lowest bytes, then all second ones, ...),
    compressed: planes of small numbers are nearly all zero."""
    import numpy as np
    import pyarrow as pa
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(raw: bytes | None, kind: str):
    import numpy as np
    import pyarrow as pa
    if not raw:
        return np.zeros(0, dtype=kind)
    flat = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd")
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(flat, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def packed_keys(keys) -> bytes:
    """Ascending 64-bit keys, as the packed differences of neighbours."""
    import numpy as np
    return packed(np.diff(keys, prepend=keys[:1] * 0).astype("<u8"))


def unpacked_keys(raw: bytes | None):
    import numpy as np
    return np.cumsum(unpacked(raw, "<u8"), dtype=np.uint64)


def rows(out: list[dict]):
    import pyarrow as pa
    return pa.Table.from_pylist(out, schema=pa.schema([
        ("block", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("seen", pa.binary()), ("more", pa.binary())]))


def row(block: int, part: int, keys=None, seen=None, more=None) -> dict:
    as_bytes = lambda x: x if x is None or isinstance(x, bytes) else x.tobytes()
    return {"block": block, "part": part, "keys": as_bytes(keys), "seen": as_bytes(seen), "more": as_bytes(more)}


def arrays(column, kind: str) -> list:
    """The arrays of a column of bytes; nulls are empty."""
    import numpy as np
    return [np.frombuffer(x.as_buffer(), dtype=kind) if x.is_valid else np.zeros(0, dtype=kind) for x in column]


def joined(column, kind: str):
    import numpy as np
    return np.concatenate(arrays(column, kind) or [np.zeros(0, dtype=kind)])
