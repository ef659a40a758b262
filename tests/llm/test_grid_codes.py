import math
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.llm import grid_codes as gc

SCHEMA = "vec_id long, embedding array<float>, label int, code int, part int"


def rows_of(n, dim=16, seed=1, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(dim)] for _ in range(5)]
    f32 = lambda x: float(np.float32(x))
    return [(k, [f32(c + rng.gauss(0, scale / 4)) for c in centres[rng.randrange(5)]], rng.choice([None, 1, 2, 3]), 7, 8) for k in range(n)]


def by_the_book(rows, parts=8, n_entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab, *_ in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    size = max(Counter(len(v) for _, v, _ in kept).items(), key=lambda x: (x[1], x[0]))[0]
    kept = [r for r in kept if len(r[1]) == size]
    width = -(-size // parts)
    kept = sorted(((i, v + [0] * (width * parts - size), lab) for i, v, lab in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:n_entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min(range(len(books[p])), key=lambda e: (dist(x, books[p][e]), e))
    for _ in range(rounds):
        took = defaultdict(list)
        for _, v, _ in kept:
            for p, x in enumerate(cut(v)):
                took[p, near(p, x)].append(x)
        for (p, e), xs in took.items():
            books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, per = [], Counter()
    for i, v, lab in kept:
        to = [near(p, x) for p, x in enumerate(cut(v))]
        error = sum(dist(x, books[p][e]) for p, (x, e) in enumerate(zip(cut(v), to)))
        per[lab] += error
        out.append((i, "".join(f"{e:02x}" for e in to), error, lab))
    sha = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = 2 ** 63 - 1
    return Counter((i, c, min(e, most), min(per[lab], most), sha) for i, c, e, lab in out)


def check(spark, rows):
    got = gc.encoded(spark.createDataFrame(rows, SCHEMA).repartition(3), ["vec_id"])
    assert Counter(tuple(r) for r in got.collect()) == by_the_book(rows)


@pytest.mark.parametrize("dim", [64, 16, 13])
def test_equals_full_evaluation(spark, dim):
    check(spark, rows_of(400, dim))


def test_ties_repeats_and_few_rows(spark):
    rows = rows_of(9)
    check(spark, rows[:5])
    check(spark, [rows[0]] * 40 + rows[1:4] + [(None, rows[5][1], None, 1, 2)] * 3 + [(3, rows[6][1], 2, 1, 2)])
    check(spark, [(k, [1.0] * 8 if k % 2 else [0.0] * 8, 1, 0, 0) for k in range(30)])


def test_values_beyond_64_bits(spark):
    rows = rows_of(60) + [(100, [1e6] * 16, 1, 0, 0), (101, [3e38, -3e38] * 8, 2, 0, 0), (102, [float(np.float32(1e-40))] * 16, 1, 0, 0)]
    check(spark, [(i, [float(np.float32(x)) for x in v], *rest) for i, v, *rest in rows])


def test_odd_vectors_are_dropped(spark):
    rows = rows_of(40)
    odd = [(200, None, 1, 0, 0), (201, [], 1, 0, 0), (202, [1.0, None] * 8, 1, 0, 0), (203, [float("nan")] * 16, 1, 0, 0),
           (204, [float("-inf")] * 16, 1, 0, 0), (205, [1.0] * 8, 1, 0, 0)]
    check(spark, odd + rows)
    assert gc.encoded(spark.createDataFrame(odd[:5], SCHEMA), ["vec_id"]).count() == 0
    assert gc.encoded(spark.createDataFrame([], SCHEMA), ["vec_id"]).count() == 0


def test_clashing_names(spark):
    out = gc.encoded(spark.createDataFrame(rows_of(20), SCHEMA).withColumn("error", F.lit("x")), ["vec_id", "code", "part", "error"])
    assert out.columns[:5] == ["vec_id", "given_code", "part", "given_error", "code"]
    assert out.where("given_code = 7 and part = 8 and given_error = 'x'").count() == 20


def test_cells_spare_evaluations_and_a_full_cache_changes_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 3000, (16, 8)).astype(np.int64)
    x = (centres[rng.integers(0, 16, 5000)] + rng.normal(0, 300, (5000, 8))).astype(np.int64)
    book = gc.Codebook(centres)
    to, d = book.nearest(x)
    full = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (to == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert book.evaluated < 0.7 * full.size
    monkeypatch.setattr(gc, "CACHE_CELLS", 10)
    again = gc.Codebook(centres)
    assert all((again.nearest(x[s:s + 100])[0] == to[s:s + 100]).all() for s in range(0, 5000, 100))
