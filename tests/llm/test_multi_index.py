import numpy as np
import pytest

from panelwise.llm import multi_index as mi

SCHEMA = "vec_id long, embedding array<float>, label int, n long"


def brute(ids, vectors, cosine):
    ok = [v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    x = np.array([np.array(v, np.float32).astype(float) if o else np.zeros(16) for v, o in zip(vectors, ok)])
    norm = np.linalg.norm(x, axis=1)
    u = x / np.where(norm > 0, norm, 1)[:, None]
    link = (u @ u.T >= cosine) & np.outer(ok, ok)
    np.fill_diagonal(link, False)
    comp = np.array(ids)
    for _ in range(len(ids)):
        new = np.array([min([comp[i], *comp[link[i]]]) for i in range(len(ids))])
        if (new == comp).all():
            break
        comp = new
    return {i: (int(link[k].sum()), int(comp[k]), bool(comp[k] == i)) for k, i in enumerate(ids)}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * 0.07
    hot = base[0] + rng.normal(size=(200, 16)) * 0.05
    all_ = np.concatenate([base, near, hot, base[5:9], base[5:9] * 3]).astype(np.float32)
    out = [list(map(float, v)) for v in all_]
    return out + [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [-0.0] * 15 + [1e-30], [0.0] * 15 + [3e30]]


def found(df, **kw):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in mi.near_duplicates(df, **kw).collect()}


@pytest.mark.parametrize("block", [2048, 32])
def test_recall_against_brute_force(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(mi.multi_index_links, "__defaults__", (mi.COSINE, mi.RECALL, block))
    df = spark.createDataFrame([(i * 3, v, 0, 1) for i, v in enumerate(vectors)], SCHEMA)
    got, want = found(df), brute([i * 3 for i in range(len(vectors))], vectors, mi.COSINE)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)  # no link below the threshold
    links = sum(w[0] for w in want.values())
    assert sum(g[0] for g in got.values()) >= 0.97 * links
    assert sum(got[i][1:] == want[i][1:] for i in want) >= 0.97 * len(want)


def test_all_cells_are_exact(spark, vectors):
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in enumerate(vectors)], SCHEMA)
    assert found(df, recall=1.0 + 1e-9) == brute(list(range(len(vectors))), vectors, mi.COSINE)


def test_multi_sequence_order():
    rng = np.random.default_rng(5)
    x, books = rng.normal(size=(20, 8)), (rng.normal(size=(7, 4)), rng.normal(size=(5, 4)))
    full = [np.argsort((((v[:4] - books[0]) ** 2).sum(1)[:, None] + ((v[4:] - books[1]) ** 2).sum(1)[None, :]).ravel()) for v in x]
    for count in (1, 2, 6, 17, 35, 99):
        assert (mi.visits(x, books, count) == np.array(full)[:, :count]).all()


def test_edges(spark):
    assert mi.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, None, 0, 1), (2, [0.0], 0, 1), (None, None, 0, 1)], SCHEMA)
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in mi.near_duplicates(odd).collect()} == {
        (1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)}
    same = spark.createDataFrame([(7, [1.0, 2.0], 0, 1)] * 3 + [(4, [2.0, 4.0], 0, 1)], SCHEMA)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in mi.near_duplicates(same).collect()) == [
        (4, 3, 4, True), (7, 3, 4, False), (7, 3, 4, False), (7, 3, 4, False)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rare_pairs_are_found(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(8000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(60, 64))
    z -= (z * x[:60]).sum(axis=1, keepdims=True) * x[:60]
    c = rng.uniform(0.951, 0.99, (60, 1))
    y = c * x[:60] + np.sqrt(1 - c * c) * z / np.linalg.norm(z, axis=1, keepdims=True)
    vectors = np.concatenate([x, y]).astype(np.float32).tolist()
    got = found(spark.createDataFrame([(i, v, 0, 1) for i, v in enumerate(vectors)], SCHEMA))
    assert sum(got[8000 + i] == (1, i, False) for i in range(60)) >= 58
    assert all(got[i] == (0, i, True) for i in range(60, 8000))


def test_ranks_of_cells():
    rng = np.random.default_rng(6)
    x, books = rng.normal(size=(30, 8)), (rng.normal(size=(9, 4)), rng.normal(size=(6, 4)))
    d = ((x[:, None, :4] - books[0]) ** 2).sum(2)[:, :, None] + ((x[:, None, 4:] - books[1]) ** 2).sum(2)[:, None, :]
    cell = rng.integers(0, 54, len(x))
    want = [int((row <= row[c] + 1e-12).sum()) for row, c in zip(d.reshape(len(x), -1), cell)]
    assert mi.ranks(x, books, cell).tolist() == want


def test_histograms_are_bounded_and_never_less_deep():
    place = np.arange(1, 300_000)
    up = mi.coarse(place)
    assert (up >= place).all() and (up <= place * 1.002 + 1).all() and len(np.unique(up)) < 6000
    assert mi.quantile(np.array([3.0, 1.0, 2.0]), np.array([1.0, 8.0, 1.0]), 0.9) == 2
    assert mi.quantile(np.array([3.0]), np.ones(1), 1.1) == float("inf")


def test_driver_memory_of_a_large_grid(spark, monkeypatch):
    import tracemalloc
    monkeypatch.setattr(mi, "WORDS", (256, 256))
    rng = np.random.default_rng(8)
    x = rng.normal(size=(9000, 64))
    x[1000:3000] = x[0] + rng.normal(size=(2000, 64)) * 0.05  # one large group
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in enumerate(x.astype(np.float32).tolist())], SCHEMA)
    _, entries, dim = mi._entries(df, "vec_id", "embedding")
    tracemalloc.start()
    books, count = mi.fit(entries, dim)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(books[0]) == len(books[1]) == 256 and 1 <= count <= 65536
    assert peak < 500e6


def test_sample_keeps_its_size_at_any_total(spark):
    entries = spark.range(20000).selectExpr("unhex(lpad(hex(id), 8, '0')) v")
    assert 900 < len(mi._sample(entries, 1000, 20000, 1)) < 1100
    assert len(mi._sample(entries, 1000, 10 ** 13, 1)) == 0
    assert len(mi._sample(entries, 30000, 20000, 1)) == 20000
