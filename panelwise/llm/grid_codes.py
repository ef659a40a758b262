"""Vector code compression (product codes) with memoised grid cells.

A vector's integers are cut into equal consecutive parts; each part position has a
codebook, fitted by rounds of "assign every part to its nearest entry, replace
entries by floored means". To assign a part, its coarse cell is looked up: the
cell is an integer box, and of each codebook only those entries matter in it
whose least distance to the box does not exceed the smallest of all entries'
greatest distances. That list is made once per cell, kept in the task's memory
by the cell's key, and only its entries are evaluated exactly for the parts that
fall into the cell. A dropped entry is strictly farther away from every point of the
box than another one, so results, ties included, are those of full evaluation.

Every round is one pass over a written table; tasks send one row of sums per
used entry, and the driver holds the codebooks alone (``ENTRIES`` times the
dimension). A task's cache holds at most ``CACHE_CELLS`` cells a part and is
emptied when full. Equal or hot vectors and labels need no special
care: sums are combined in the tasks, and label sums before the shuffle.

Arithmetic is exact: 64-bit integers while every square sum fits, Python
integers otherwise. An error beyond 2^63 - 1 is returned as 2^63 - 1.

Defined results: vectors that are null, empty, hold null or non-finite components,
or have another length than most vectors (ties: the longer) are dropped. A length
that is no multiple of the parts is filled up with zeros. Entries start as
the parts of the first ``ENTRIES`` rows by id (null ids last), equal ids by their
components; fewer rows give fewer entries. Repeated rows count as often as they are there.
A column asked for that is named like a result is returned as ``given_<name>``. An
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .common import fields, returned_as, ship, table, written

ship(__name__)

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELLS = 6             # cells across the spread of a codebook, along each axis
CACHE_CELLS = 1 << 16
RESULTS = ("code", "error", "label_error", "codebooks_sha256")


def integers(lists, dim: int, scale: int):
    """floor(scale * x) of a list column as an array of shape (rows, dim):
    int64 if every sum of squared differences fits, else Python integers."""
    import math
    import numpy as np
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * scale).reshape(len(lists), -1)
    if x.shape[1] < dim:
        x = np.concatenate([x, np.zeros((len(x), dim - x.shape[1]))], axis=1)
    if not x.size or np.abs(x).max() < exact_limit(dim):
        return x.astype(np.int64)
    return np.array([[math.floor(y) for y in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def exact_limit(dim: int) -> int:
    """Integers below this in size, and cells around them, have squared
    distances far below 2^63."""
    import math
    return math.isqrt((1 << 62) // max(1, dim)) // 8


@dataclass
class Codebook:
    """One part position's entries and the lists of the cells met so far."""

    entries: object  # (entries, width) integers

    def __post_init__(self):
        import numpy as np
        e = self.entries
        spread = max((int(x.max()) - int(x.min()) for x in e.T), default=0) if len(e) else 0
        self.side = max(1, -(-spread // CELLS))
        self.cache: dict[bytes, object] = {}
        self.full = np.ones(len(e), dtype=bool)
        self.evaluated = 0

    def keep(self, cells):
        """For each cell (its integer coordinates) which entries are not
        dominated in it."""
        import numpy as np
        low = cells[:, None, :] * self.side
        high = low + (self.side - 1)
        e = (self.entries if cells.dtype != object else self.entries.astype(object))[None]
        near = np.maximum(np.maximum(low - e, e - high), 0)
        far = np.maximum(abs(e - low), abs(e - high))
        least, most = (near * near).sum(axis=2), (far * far).sum(axis=2)
        return (least <= most.min(axis=1)[:, None]).astype(bool)

    def kept(self, x):
        """(rows, entries): the entries to evaluate for each part, from the
        cache of its cell."""
        import numpy as np
        cells = x // self.side
        small = cells.astype(np.int8) if cells.dtype != object and len(cells) and abs(cells).max() < 128 else None
        if small is not None and small.shape[1] == 8:
            _, first, back = np.unique(np.ascontiguousarray(small).view(np.uint64)[:, 0], return_index=True, return_inverse=True)
            keys = [small[i].tobytes() for i in first]
        else:
            at: dict = {}
            rows = [repr(c).encode() for c in cells.tolist()]
            back = np.array([at.setdefault(k, len(at)) for k in rows], dtype=np.int64)
            keys, first = list(at), np.unique(back, return_index=True)[1]
        if len(self.cache) + len(keys) > CACHE_CELLS:
            self.cache.clear()
        new = [i for i, k in enumerate(keys) if k not in self.cache]
        for s in range(0, len(new), 4096):
            some = new[s:s + 4096]
            for i, m in zip(some, self.keep(cells[first[some]])):
                self.cache[keys[i]] = m
        return np.array([self.cache[k] for k in keys]).reshape(len(keys), len(self.full))[back]

    def nearest(self, x):
        """Each part's nearest entry, of equal ones the first, and the squared distance."""
        import numpy as np
        e = self.entries
        if object in (x.dtype, e.dtype):  # Python integers on both sides
            x, e = x.astype(object), e.astype(object)
        row, entry = np.nonzero(self.kept(x))
        self.evaluated += len(row)
        d = x[row] - e[entry]
        d = (d * d).sum(axis=1)
        start = np.searchsorted(row, np.arange(len(x)))  # every part has an entry at least
        least = np.minimum.reduceat(d, start) if len(x) else d
        hit = np.flatnonzero(d == least[row])
        hit = hit[np.searchsorted(row[hit], np.arange(len(x)))]
        return entry[hit], d[hit]


def codebooks_of(entries: list[list[list[int]]], dim: int) -> list[Codebook]:
    import numpy as np
    big = max((abs(v) for part in entries for e in part for v in e), default=0)
    return [Codebook(np.array(part, dtype=np.int64 if big < exact_limit(dim) else object)) for part in entries]


def sums(kept: DataFrame, entries: list, dim: int, parts: int, scale: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """One round: (part, entry) -> (count, sums of the components) of the parts assigned to it."""
    width = dim // parts

    def work(batches):
        import numpy as np
        import pyarrow as pa
        books, total = codebooks_of(entries, dim), {}
        for b in batches:
            x = integers(b.column(0), dim, scale)
            for p, book in enumerate(books):
                v = x[:, p * width:(p + 1) * width]
                to, _ = book.nearest(v)
                order = np.argsort(to, kind="stable")
                used, start = np.unique(to[order], return_index=True)
                for e, s, n in zip(used.tolist(), np.add.reduceat(v[order], start, axis=0).tolist() if len(used) else [],
                                   np.diff([*start, len(order)]).tolist()):
                    before = total.get((p, e), (0, [0] * width))
                    total[p, e] = (before[0] + n, [a + c for a, c in zip(before[1], s)])
        yield pa.RecordBatch.from_pylist([{"part": p, "entry": e, "n": n, "total": [str(v) for v in s]} for (p, e), (n, s) in total.items()],
                                         schema=pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.string()))]))

    def merge(key, tbl):
        """An entry's sums from all tasks; one row a task."""
        import pyarrow as pa
        rows = [[int(v) for v in r] for r in tbl.column("total").to_pylist()]
        total = [str(sum(c)) for c in zip(*rows)]
        return pa.table({"part": [key[0].as_py()], "entry": [key[1].as_py()], "n": [sum(tbl.column("n").to_pylist())], "total": [total]},
                        schema=tbl.schema)

    shape = "part int, entry int, n long, total array<string>"
    rows = kept.select("__v").mapInArrow(work, shape).groupBy("part", "entry").applyInArrow(merge, shape).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(v) for v in r["total"]]) for r in rows}


def fit(kept: DataFrame, dim: int, parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list:
    """The codebooks: per part a list of entries, each a list of integers."""
    import pyarrow as pa
    first = kept.orderBy(F.col("__id").asc_nulls_last(), "__v").limit(n_entries).select("__v").collect()
    rows = integers(pa.array([list(r[0]) for r in first], pa.list_(pa.float64())), dim, scale).tolist() if first else []
    width = dim // parts
    entries = [[r[p * width:(p + 1) * width] for r in rows] for p in range(parts)]
    for _ in range(rounds if rows else 0):
        for (p, e), (n, total) in sums(kept, entries, dim, parts, scale).items():
            entries[p][e] = [v // n for v in total]
    return entries


def digest(entries: list) -> str:
    from hashlib import sha256
    return sha256(",".join(str(v) for part in entries for e in part for v in e).encode()).hexdigest()


def encoded(vectors: DataFrame, columns: list[str], id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
            parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``columns`` of every kept vector, code (the parts' entries, two hex
    digits each), error (squared distance to the code), label_error (errors of all vectors
    with the same label) and codebooks_sha256."""
    if n_entries > 256:
        raise ValueError("codes have two hex digits a part: at most 256 entries")
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce((x == x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    held = vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(finite)
    held = held.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__v"), F.col(label_col).alias("__label"),
                       *[F.col(c).alias(f"__c{i}") for i, c in enumerate(columns)])
    lengths = held.groupBy(F.size("__v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    length = lengths[0]["n"] if lengths else 0
    dim = -(-length // parts) * parts
    kept = written(held.where(F.size("__v") == length), "vectors")
    entries = fit(kept, dim, parts, n_entries, rounds, scale)
    width = dim // parts
    own = [f"__c{i}" for i in range(len(columns))]

    def work(batches):
        import numpy as np
        import pyarrow as pa
        books = codebooks_of(entries, dim)
        names = np.array([f"{i:02x}" for i in range(256)])
        for b in batches:
            x = integers(b.column("__v"), dim, scale)
            code, error = np.full(len(x), "", dtype=f"<U{2 * parts}"), 0
            for p, book in enumerate(books):
                to, d = book.nearest(x[:, p * width:(p + 1) * width])
                code = np.char.add(code, names[to])
                error = error + d
            most = (1 << 63) - 1
            error = [min(int(e), most) for e in error] if len(x) else []
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("__label", *own)], pa.array(code.tolist(), pa.string()), pa.array(error, pa.int64())],
                                             names=["__label", *own, "__code", "__error"])

    result = written(kept.mapInArrow(work, fields(kept, ["__label", *own], "__code string, __error long")), "codes")
    # Sums of longs may pass a long: added as decimals and cut at its end.
    by_label = result.groupBy(F.col("__label").alias("__of")).agg(
        F.least(F.sum(F.col("__error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long").alias("__sum"))
    joined = result.join(by_label, F.col("__label").eqNullSafe(F.col("__of")))
    return joined.select(*[F.col(c).alias(n) for c, n in zip(own, returned_as(columns, RESULTS))], F.col("__code").alias("code"),
                         F.col("__error").alias("error"), F.col("__sum").alias("label_error"), F.lit(digest(entries)).alias("codebooks_sha256"))


def op11_grid_codes(spark, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "embeddings"), ["vec_id"])


def _sql(parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """Full evaluation, round by round."""
    square = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, p.part, entry, p.x, {square} AS dist FROM p JOIN c{r} c ON c.part = p.part
       QUALIFY row_number() OVER (PARTITION BY rid, p.part ORDER BY dist, entry) = 1)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS x
       FROM (SELECT part, entry, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY ALL)
       GROUP BY part, entry)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.part = c.part AND m.entry = c.entry)")
    body = ",\n".join(steps)
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
                  list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, part::INTEGER AS part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
     FROM (SELECT rid, v, unnest(range(0, {parts})) AS part FROM k)),
c0 AS (SELECT part, (rid - 1)::INTEGER AS entry, x FROM p WHERE rid <= {n_entries}),
{body},
e AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS sha FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM k JOIN e USING (rid), h
"""


SQL = _sql()
