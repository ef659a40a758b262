"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: 64 bits; a bit is set if more than half of a text's shingle
hashes (XXH64, seed 42) have it. Documents with equal fingerprints are one
entry of the index. Entries link at ``distance`` or fewer differing bits.

The index is spread by bit blocks: of ``distance + 2`` blocks, two entries
that link agree in at least two, so an entry is filed once under every pair of
blocks and a pair of entries meets under one of them. (With two agreeing
blocks as the key, a key's group holds N / 2^32 random entries.) Inside a
group the entries are sorted by Gray rank, so that those sharing leading bits
are neighbours: a node of the hierarchy is a run of entries with the same
masked bits, its children share more. Pairs of nodes descend together, the
differences of their masked patterns accumulate, and pairs of whole nodes
beyond ``distance`` are pruned. What is left at the last level are links.

A group that is large (near copies of one text, or a common block pair) is
filed again under pairs of its remaining bits, by the same argument, before
any task sees it; groups then hold only entries that share most bits, and at
most a small ball of distinct fingerprints fits in one. Links inside a group
leave it as a spanning forest, never as all pairs.

Defined results: a text with fewer words than a shingle is one shingle of all
its words; a null, empty or blank text has fingerprint zero and links like any
other; rows with equal ids keep their own row and share a component through
the id; a null id is never a component id unless nothing else is reachable; an empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .common import asked_for, batches_of, fields, returned_as, ship, small_batches, table, text_or_empty, written
from .graph import components

ship(__name__)

WORDS = 3
DISTANCE = 2
SEED = 42
LARGE = 4096  # entries of a group that one task takes


def fingerprints_of(texts: list, words: int = WORDS, seed: int = SEED):
    """uint64 fingerprints of texts."""
    import numpy as np
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    for k, t in enumerate(texts):
        ws = t.encode("utf-8", "replace").lower().split() if t else []
        n = len(ws)
        if not n:
            continue
        if n <= words:
            out[k] = xxh64_intdigest(b" ".join(ws), seed)
            continue
        joined = b" ".join(ws)
        size = np.fromiter(map(len, ws), np.int64, n) + 1
        ends = np.cumsum(size)
        starts = (ends - size)[:n - words + 1].tolist()
        h = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, (ends[words - 1:] - 1).tolist())], dtype="<u8")
        set_bits = np.zeros(64, dtype=np.int64)
        for s in range(0, len(h), 8192):
            set_bits += np.unpackbits(h[s:s + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(set_bits * 2 > len(h), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, columns: list[str], text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``columns`` and fp long (the fingerprint's bits as a signed integer)."""
    small_batches(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            last = b.num_columns - 1
            for s, e in batches_of(b.column(last), 1 << 22):
                part = b.slice(s, e - s)
                fp = fingerprints_of(part.column(last).to_pylist(), words, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(fp)], [*part.schema.names[:-1], "fp"])

    given = docs.select(*columns, text_or_empty(text_col).alias("__text"))
    return given.mapInArrow(run, fields(given, columns, "fp long"))


def gray_rank(x):
    """The place of each uint64 in Gray-code order."""
    import numpy as np
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def linked_pairs(fp, distance: int = DISTANCE):
    """Index pairs (i < j, of the given array) of distinct fingerprints at
    ``distance`` or fewer differing bits, by descending pairs of nodes of the Gray-ordered hierarchy.
    Yields arrays of pairs."""
    import numpy as np
    u = np.uint64
    order = np.argsort(gray_rank(fp), kind="stable")
    f = fp[order]
    n = len(f)
    levels = []  # per level: first entry of each node, and one past the last
    for bits in range(8, 65, 8):
        masked = f >> u(64 - bits)
        first = np.flatnonzero(np.concatenate([[True], masked[1:] != masked[:-1]]))
        levels.append((first, np.concatenate([first[1:], [n]]), masked[first]))

    def descend(level, a, b):
        """a, b: nodes of ``level`` whose patterns differ in few enough bits."""
        if level == len(levels) - 1:
            keep = a != b
            i, j = order[a[keep]], order[b[keep]]  # one entry a node at 64 bits
            yield np.minimum(i, j), np.maximum(i, j)
            return
        first, stop, _ = levels[level]
        child_first, _, pattern = levels[level + 1]
        lo, hi = np.searchsorted(child_first, first), np.searchsorted(child_first, stop)
        step = max(1, len(a))
        wide = (hi[a] - lo[a]) * (hi[b] - lo[b])
        # Bounded blocks: at most about a million child pairs at a time.
        start = 0
        total = np.cumsum(wide)
        while start < len(a):
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + 1_000_000, side="right")))
            x, y, w = a[start:end], b[start:end], wide[start:end]
            at = np.repeat(np.arange(len(x)), w)
            within = np.arange(len(at)) - np.repeat(np.cumsum(w) - w, w)
            span = (hi[y] - lo[y])[at]
            ca, cb = lo[x][at] + within // span, lo[y][at] + within % span
            near = (ca <= cb) & (np.bitwise_count(pattern[ca] ^ pattern[cb]) <= distance)
            if near.any():
                yield from descend(level + 1, ca[near], cb[near])
            start = end

    m = len(levels[0][0])
    pattern = levels[0][2]
    a, b = np.nonzero(np.triu(np.bitwise_count(pattern[:, None] ^ pattern[None, :]) <= distance)) if m else ([], [])
    if m:
        yield from descend(0, a, b)


def spanning_links(fp, distance: int = DISTANCE):
    """(a, b): a spanning forest of the links among distinct fingerprints,
    every entry beside the first of its component."""
    import numpy as np
    root = np.arange(len(fp))
    for i, j in linked_pairs(fp, distance):
        while len(i):
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, hi, lo)
            while True:  # halve paths until every entry points to a root
                up = root[root]
                if (up == root).all():
                    break
                root = up
    beside = np.flatnonzero(root != np.arange(len(fp)))
    return fp[beside], fp[root[beside]]


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    size = [len(bits) // n + (i < len(bits) % n) for i in range(n)]
    out, at = [], 0
    for s in size:
        out.append(bits[at:at + s])
        at += s
    return out


def _ways(free: list[int], distance: int) -> list[tuple[int, int, list[int]]]:
    """(number, mask, bits still free) of every pair of ``distance + 2`` blocks of the free bits."""
    blocks = _blocks(free, distance + 2)
    ways = []
    for k, (a, b) in enumerate(combinations(range(len(blocks)), 2)):
        mask = sum(1 << i for i in blocks[a] + blocks[b])
        ways.append((k, mask, [i for c, bl in enumerate(blocks) if c not in (a, b) for i in bl]))
    return ways


def _keys(ways: list) -> Column:
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return F.array(*[F.struct(F.lit(k).cast("long").alias("way"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("part"))
                     for k, m, _ in ways])


def _filed(entries: DataFrame, keys: Column) -> DataFrame:
    """Entries (fp, key) once under each of their further keys."""
    return (entries.withColumn("__k", F.explode(keys))
            .select("fp", F.concat(F.col("key"), F.array(F.col("__k.way"), F.col("__k.part"))).alias("key")))


def fingerprint_links(entries: DataFrame, distance: int = DISTANCE, large: int = LARGE) -> DataFrame:
    """(a, b) links of distinct fingerprints (column fp) that connect exactly
    what ``distance`` or fewer differing bits connect."""
    def forest(key, tbl):
        import numpy as np
        import pyarrow as pa
        fp = np.unique(tbl.column("fp").to_numpy().view(np.uint64))
        a, b = spanning_links(fp, distance)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    start = entries.withColumn("key", F.array().cast("array<bigint>"))
    ways = _ways(list(range(64)), distance)
    filed = _filed(start, _keys(ways))
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # Groups of one entry have no links and go; large groups are filed again.
    small = filed.join(sizes.where(F.col("n") <= large), "key").select("fp", "key")
    big = written(filed.join(sizes.where(F.col("n") > large), "key").select("fp", "key"), "large-groups")
    # One filing for the groups of all ways, each under its own free bits: one
    # exchange and one plan whatever the number of ways.
    own = F.coalesce(*[F.when(F.col("key")[0] == k, _keys(_ways(free, distance))) for k, _, free in ways])
    return small.unionByName(_filed(big, own)).groupBy("key").applyInArrow(forest, "a long, b long")


def near_duplicates(docs: DataFrame, columns: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, distance: int = DISTANCE, with_root: bool = False) -> DataFrame:
    """One row per document: id, ``columns``, fp long and component_id, the
    smallest id that links reach; if asked for, also root: one number per
    component, whatever its ids. A column named like one of these is returned as ``given_<name>``."""
    results = [id_col, "fp", "component_id", *["root"] * with_root]
    names = returned_as(columns or [], results)
    given = docs.select(id_col, *asked_for(columns or [], results), F.col(text_col).alias("__given_text"))
    marked = written(fingerprints(given, [id_col, *names], "__given_text", words), "simhash")  # texts only if asked for
    entries = written(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-entries")
    roots = components(fingerprint_links(entries.select("fp"), distance))
    # Least id of each component, from one row per distinct fingerprint.
    of = entries.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.select("fp", "root").join(least, "root").select(F.col("fp").alias("__fp"), "component_id", *["root"] * with_root)
    return marked.join(named, F.col("fp") == F.col("__fp")).drop("__fp")


def first_of_id(docs: DataFrame, columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """One row per id: the least by the other columns. Rows are compared with
    a minimum that combines before the shuffle, so a repeated id is not hot."""
    rest = [c for c in columns if c != id_col]
    one = docs.groupBy(id_col).agg(F.min(F.struct(*rest)).alias("__first"))
    return one.select(id_col, *[F.col("__first")[c].alias(c) for c in rest]).select(*columns)


def op5_simhash_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
