"""Embedding near-duplicates over an inverted multi-index.

Unit vectors are cut into halves, each with its own codebook; a vector's cell
is its pair of nearest codewords, so two codebooks of k words make a grid of
k * k cells. A search visits cells in the order of the sum of both halves'
distances (multi-sequence order) and stops after the count of cells that
reaches the target recall, measured on a sample of queries. (Stopping at a
distance over that of the first cell visits up to twice as many for the same recall.) Partners planted at
exactly the linking cosine make up for partners that the sample has not: pairs
count as found if either end visits the other's cell. The true links of the
sample to other vectors (a query is no partner of itself) have to be reached too.
What a search meets is verified by the cosine in double precision.

Equal vectors are one entry with a count. A cell's entries and its visitors
are dealt into blocks, and one task compares one block of each, so a
cell that holds a third of all entries is spread like any other. Links leave a
task as counts per vector and as a spanning forest, never as all pairs. A link
counts for both ends whichever end found it: a task knows from both visit lists
whether the other direction finds the link as well.

Fitted on bounded samples: codebooks on about ``TRAIN`` vectors (or
``PER_WORD`` a codeword), the count of
visited cells on about ``QUERIES`` queries. The index holds every vector.
The grid grows with the entries until ``WORDS[1]`` squared cells (a thousand
million entries); beyond that cells hold more. How deep queries find their
partners is summed in tasks: the driver gets one histogram of bounded size.

Defined results: a vector that is null, empty, zero, holds null or non-finite components, or
has another length than most vectors links with nothing and is its own
component; rows with equal ids keep their own rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import ship, small_batches, table, written
from .graph import components

ship(__name__)

COSINE = 0.95
RECALL = 0.999
TRAIN = 8192
QUERIES = 1024
PER_CELL = 64      # entries a cell, about, when codebooks are sized
PER_WORD = 16      # training vectors a codeword, at least
WORDS = (8, 4096)  # least and most codewords of a half
BLOCK = 2048       # entries or visitors of a cell in one task
SMALL_GRID = 65_536  # cells whose block counts (24 bytes each) are broadcast
SEED = 11


def unit(raw: list, dim: int):
    """Unit rows in double precision from little-endian float32 bytes."""
    import numpy as np
    x = np.frombuffer(b"".join(raw), dtype="<f4").reshape(-1, dim).astype(np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)  # scaled first: no square under- or overflows
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x, words):
    """Squared distances of rows to codewords."""
    import numpy as np
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)[None, :], 0)


def nearest(x, words):
    """The nearest codeword of each row, some million distances at a time."""
    import numpy as np
    step = max(1, 4_000_000 // len(words))
    return np.concatenate([np.zeros(0, np.int64), *(distances(x[s:s + step], words).argmin(axis=1) for s in range(0, len(x), step))])


def codebook(x, k: int, rounds: int = 12, seed: int = SEED):
    """k-means of rows."""
    import numpy as np
    rng = np.random.default_rng(seed)
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, words)
        n = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, x)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def first_words(x, words, count: int):
    """The ``count`` nearest codewords of each row in order, and their distances."""
    import numpy as np
    d = distances(x, words)
    if count < len(words):
        part = np.argpartition(d, count - 1, axis=1)[:, :count]
        part.sort(axis=1)  # equal distances stay in order of the codewords
        d = np.take_along_axis(d, part, 1)
        o = d.argsort(axis=1, kind="stable")
        return np.take_along_axis(part, o, 1), np.take_along_axis(d, o, 1)
    o = d.argsort(axis=1, kind="stable")
    return o, np.take_along_axis(d, o, 1)


def visits(x, books, count: int):
    """The first ``count`` cells of each row in multi-sequence order.

    The cell of rank i in one half and j in the other comes after the
    (i+1)(j+1) - 1 cells of ranks up to i and j, so only rank pairs with
    (i+1)(j+1) <= count can be among the first ``count``."""
    import numpy as np
    h = x.shape[1] // 2
    o1, s1 = first_words(x[:, :h], books[0], min(count, len(books[0])))
    o2, s2 = first_words(x[:, h:], books[1], min(count, len(books[1])))
    wide = np.minimum(o2.shape[1], count // np.arange(1, o1.shape[1] + 1))
    i = np.repeat(np.arange(len(wide)), wide)
    j = np.arange(len(i)) - np.repeat(np.cumsum(wide) - wide, wide)
    count = min(count, len(i))
    total = s1[:, i] + s2[:, j]
    pick = np.argsort(total, axis=1, kind="stable")[:, :count]
    at = np.arange(len(x))[:, None]
    return o1[at, i[pick]] * len(books[1]) + o2[at, j[pick]]


def ranks(x, books, cell):
    """The place (from 1) of one given cell of each row in multi-sequence
    order; of equal sums the last."""
    import numpy as np
    h = x.shape[1] // 2
    d1, d2 = distances(x[:, :h], books[0]), distances(x[:, h:], books[1])
    at = np.arange(len(x))
    total = d1[at, cell // len(books[1])] + d2[at, cell % len(books[1])] + 1e-12
    d2 = np.sort(d2, axis=1)
    return np.array([np.searchsorted(b, t - a, side="right").sum() for a, b, t in zip(d1, d2, total)], dtype=np.int64)


def coarse(place):
    """Places rounded up to nine leading bits: few different ones, none less deep."""
    import numpy as np
    step = 1 << np.maximum(0, np.floor(np.log2(place)).astype(np.int64) - 9)
    return -(-place // step) * step


def quantile(at, weight, share: float) -> float:
    """The least of ``at`` that has ``share`` of the weight up to it; infinite beyond all."""
    import numpy as np
    if not len(at):
        return 0
    order = np.argsort(at, kind="stable")
    by = np.cumsum(weight[order])
    k = int(np.searchsorted(by / by[-1], share))
    return at[order[k]] if k < len(at) else float("inf")


def planted_ranks(queries, books, cosine: float, seed: int = SEED):
    """Per kind of direction: how deep the traversal of a query or of a partner
    at just this cosine, whichever is less deep, finds the other one. The
    partner lies anywhere, beside one half only, or towards another query."""
    import numpy as np
    rng = np.random.default_rng(seed)
    x = np.tile(queries, (-(-QUERIES // max(1, len(queries))), 1))
    h = x.shape[1] // 2
    anywhere = rng.normal(size=x.shape)
    first, second = anywhere.copy(), anywhere.copy()
    first[:, h:], second[:, :h] = 0, 0
    out = []
    for z in (anywhere, first, second, x[rng.permutation(len(x))]):
        z = z - (z * x).sum(axis=1, keepdims=True) * x
        size = np.sqrt((z * z).sum(axis=1))
        ok = size > 1e-6
        a = x[ok]
        b = cosine * a + (1 - cosine * cosine) ** 0.5 * z[ok] / size[ok, None]
        if len(a):
            out.append(np.minimum(ranks(a, books, visits(b, books, 1)[:, 0]), ranks(b, books, visits(a, books, 1)[:, 0])))
    return out


def forest(a, b, n: int):
    """Spanning links of the graph on 0..n-1 with links (a, b)."""
    import numpy as np
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    beside = np.flatnonzero(root != np.arange(n))
    return root[beside], beside


def _entries(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(rows, entries, dim): rows (id, v) with v the float32 bytes or null;
    entries (eid, v, least id, n), one per distinct v."""
    v = F.col(vec_col)
    bad = v.isNull() | (F.size(v) == 0) | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        | ~F.exists(v, lambda x: x != 0)
    sized = vectors.select(F.col(id_col).alias("id"), F.when(~F.coalesce(bad, F.lit(True)), v).alias("e"))
    common = (sized.where("e IS NOT NULL").groupBy(F.size("e").alias("d")).count()
              .orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect())
    dim = common[0]["d"] if common else 0

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            e = b.column(1)
            full = np.asarray(e.is_valid()) if len(e) else np.zeros(0, bool)
            flat = np.asarray(e.drop_null().flatten(), dtype="<f4").reshape(-1, max(1, dim)) + np.float32(0)  # -0 is 0
            it = iter(flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([next(it).tobytes() if ok else None for ok in full], pa.binary())], ["id", "v"])

    kind = vectors.schema[id_col].dataType.simpleString()
    rows = written(sized.select("id", F.when(F.size("e") == dim, F.col("e").cast("array<float>")).alias("e"))
                   .mapInArrow(pack, f"id {kind}, v binary"), "vectors")
    entries = written(rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
                      .withColumn("eid", F.monotonically_increasing_id()), "vector-entries")
    return rows, entries, dim


def _sample(entries: DataFrame, size: int, total: int, salt: int) -> list:
    """About ``size`` of ``total`` entries by a hash of the vector, at any total."""
    pick = F.xxhash64("v", F.lit(salt)).bitwiseAND((1 << 62) - 1) <= int(min(1.0, size / max(1, total)) * (1 << 62))
    return sorted(r["v"] for r in entries.where(pick).select("v").collect())


def fit(entries: DataFrame, dim: int, cosine: float = COSINE, recall: float = RECALL):
    """(codebooks, count of cells to visit)."""
    import numpy as np
    total = entries.count()
    k = int(np.clip(round((total / PER_CELL) ** 0.5), *WORDS))
    train = unit(_sample(entries, max(TRAIN, PER_WORD * k), total, SEED), dim)
    h = dim // 2
    books = (codebook(train[:, :h], k), codebook(train[:, h:], k))
    cells = len(books[0]) * len(books[1])
    drawn = _sample(entries, QUERIES, total, SEED + 1)
    own = {v: i for i, v in enumerate(drawn)}
    queries = unit(drawn, dim) if drawn else np.zeros((0, dim))

    def partners(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column(0).to_pylist()
            x = unit(raw, dim)
            cell = visits(x, books, 1)[:, 0]
            near = queries @ x.T >= cosine
            for i, v in enumerate(raw):
                if v in own:  # entries are distinct: this is the query itself
                    near[own[v], i] = False
            q, m = np.nonzero(near)
            at, n = np.unique(np.stack((q, cell[m])), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(n)], ["q", "cell", "n"])

    # Where the true partners of the queries are, one row per query and cell.
    hits = written(entries.select("v").mapInArrow(partners, "q long, cell long, n long")
                   .groupBy("q", "cell").agg(F.sum("n").alias("n")), "multi-index-sample")
    of = {r["q"]: r["n"] for r in hits.groupBy("q").agg(F.sum("n").alias("n")).collect()}  # one row per query

    def deep(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                q, cell, n = (c.to_numpy() for c in b.slice(s, 1000).columns)
                each = n / np.array([of[i] for i in q.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(coarse(ranks(queries[q], books, cell))), pa.array(n.astype(float)), pa.array(each)], ["place", "links", "queries"])

    # Places are rounded up, so at most some ten thousand rows.
    found = (hits.mapInArrow(deep, "place long, links double, queries double")
             .groupBy("place").agg(F.sum("links").alias("links"), F.sum("queries").alias("queries")).collect())
    at = np.array([r["place"] for r in found], dtype=np.int64)
    need = [quantile(at, np.array([r[w] for r in found]), recall) for w in ("links", "queries")]
    need += [quantile(d, np.ones(len(d)), recall) for d in planted_ranks(queries, books, cosine)]
    return books, int(min(max(1, *need), cells))


def multi_index_links(entries: DataFrame, dim: int, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(eid, other, links): rows with ``other`` null add ``links`` to an
    entry's count of linked vectors, rows with ``other`` are forest links."""
    spark = entries.sparkSession
    small_batches(spark, 2000)
    books, count = fit(entries, dim, cosine, recall)
    fitted = spark.sparkContext.broadcast((books, count))  # 2 codebooks of at most WORDS[1] rows

    def index(batches):
        import numpy as np
        import pyarrow as pa
        books, count = fitted.value
        for b in batches:
            v = b.column(2)
            if not len(v):
                continue
            way = visits(unit(v.to_pylist(), dim), books, count)
            ends = np.arange(len(way) + 1, dtype=np.int32) * way.shape[1]
            way = pa.ListArray.from_arrays(pa.array(ends), pa.array(way.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, way], ["eid", "n", "v", "way"])

    placed = written(entries.select("eid", "n", "v").mapInArrow(index, "eid long, n long, v binary, way array<int>")
                     .withColumn("cell", F.col("way")[0]), "multi-index")
    # Both counts have one row per cell. Larger grids leave the join to Spark's
    # size check and AQE, which splits a hot cell.
    held = placed.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("mine"))
    asked = placed.select(F.explode("way").alias("cell")).groupBy("cell").agg(F.ceil(F.count("*") / block).alias("theirs"))
    blocks = held.join(asked, "cell")
    if len(books[0]) * len(books[1]) <= SMALL_GRID:
        blocks = F.broadcast(blocks)
    spot = lambda n, salt: F.pmod(F.xxhash64("eid", F.lit(salt)), n)
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    members = (placed.join(blocks, "cell").withColumn("a", spot(F.col("mine"), 1)).withColumn("b", spread(F.col("theirs")))
               .select("cell", "a", "b", "eid", "n", "v", "way"))
    visitors = (placed.select("eid", "n", "v", F.col("cell").alias("home"), F.explode("way").alias("cell"))
                .join(blocks, "cell").withColumn("b", spot(F.col("theirs"), 2)).withColumn("a", spread(F.col("mine")))
                .select(*[F.col(c).alias(f"q_{c}") for c in ("cell", "a", "b", "eid", "n", "v", "home")]))

    def compare(key, mine, theirs):
        import numpy as np
        import pyarrow as pa
        kinds = [("eid", pa.int64()), ("other", pa.int64()), ("links", pa.int64())]
        if not mine.num_rows or not theirs.num_rows:
            return pa.table({c: pa.array([], k) for c, k in kinds})
        m_id, q_id = mine.column("eid").to_numpy(), theirs.column("q_eid").to_numpy()
        m_n, q_n = mine.column("n").to_numpy(), theirs.column("q_n").to_numpy()
        home = theirs.column("q_home").to_numpy()
        way = mine.column("way").combine_chunks().flatten().to_numpy().reshape(mine.num_rows, -1)
        sim = unit(theirs.column("q_v").to_pylist(), dim) @ unit(mine.column("v").to_pylist(), dim).T
        q, m = np.nonzero(sim >= cosine)
        other = q_id[q] != m_id[m]
        q, m = q[other], m[other]
        q_links = np.bincount(q, m_n[m], minlength=len(q_id)).astype(np.int64)
        found_back = np.zeros(len(q), dtype=bool)
        for s in range(0, len(q), 100_000):
            e = s + 100_000
            found_back[s:e] = (way[m[s:e]] == home[q[s:e], None]).any(axis=1)
        lone = ~found_back
        m_links = np.bincount(m[lone], q_n[q[lone]], minlength=len(m_id)).astype(np.int64)
        both, inv = np.unique(np.concatenate((q_id, m_id)), return_inverse=True)
        root, node = forest(inv[:len(q_id)][q], inv[len(q_id):][m], len(both))
        has_q, has_m = q_links > 0, m_links > 0
        eid = np.concatenate((q_id[has_q], m_id[has_m], both[node]))
        links = np.concatenate((q_links[has_q], m_links[has_m], np.zeros(len(node), dtype=np.int64)))
        to = pa.array(np.concatenate((np.zeros(len(eid) - len(node), dtype=np.int64), both[root])),
                      mask=np.arange(len(eid)) < len(eid) - len(node))
        return pa.table({"eid": pa.array(eid), "other": to, "links": pa.array(links)})

    return (members.groupBy("cell", "a", "b").cogroup(visitors.groupBy("q_cell", "q_a", "q_b"))
            .applyInArrow(compare, "eid long, other long, links long"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    rows, entries, dim = _entries(vectors, id_col, vec_col)
    if not dim:
        named = entries.select("v", F.lit(0).cast("long").alias("n_links"), F.col("least").alias("component"))
    else:
        found = written(multi_index_links(entries, dim, cosine, recall), "vector-links")
        links = found.where("other IS NULL").groupBy("eid").agg(F.sum("links").alias("links"))
        roots = components(found.where("other IS NOT NULL"), "eid", "other")
        e = (entries.join(links, "eid", "left").join(roots.withColumnRenamed("node", "eid"), "eid", "left")
             .withColumn("root", F.coalesce("root", "eid"))
             .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n") - 1))
        least = e.groupBy("root").agg(F.min("least").alias("component"))
        named = e.join(least, "root").select("v", "n_links", "component")
    return (rows.join(named.withColumnRenamed("v", "__v"), F.col("v") == F.col("__v"), "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def op7_embedding_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
