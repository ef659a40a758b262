import numpy as np
from xxhash import xxh64_intdigest

from panelwise.llm import simhash

from .conftest import make_docs, some_texts


def fingerprint(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(ids, fps, distance=2):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                p, q = find(ids[a]), find(ids[b])
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_fingerprints():
    texts = some_texts() + ["one two", "A  b\tC d"]
    assert simhash.fingerprints_of(texts).tolist() == [fingerprint(t) for t in texts]


def test_linked_pairs_by_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    near = [base]
    for _ in range(8):
        x = base.copy()
        for _ in range(int(rng.integers(0, 4))):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        near.append(x)
    fp = np.unique(np.concatenate([*near, np.array([0, 1, 3, 2 ** 64 - 1], np.uint64)]))
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= 2}
    got = [(int(i), int(j)) for a, b in simhash.linked_pairs(fp) for i, j in zip(a, b)]
    assert sorted(got) == sorted(want)


def test_components_with_large_groups(spark):
    rng = np.random.default_rng(2)
    one = int(rng.integers(0, 2 ** 63))
    ball = {one ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (60, 2))}
    chain, x = [], one ^ 0xFFFF
    for k in range(12):  # each two bits from the one before
        x ^= 3 << 2 * k + 20
        chain.append(x)
    fps = sorted(ball | set(chain) | {0, 7, 2 ** 64 - 1})
    entries = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    from panelwise.llm.graph import components
    for large in (4096, 3):  # 3: groups are filed again
        got = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(entries, large=large)).collect()}
        signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
        want = roots(signed, [f & (2 ** 64 - 1) for f in signed])
        assert {i: got.get(i, i) for i in signed} == want


def test_documents(spark, docs, no_docs):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    texts = some_texts()
    fps = [fingerprint(t) for t in texts]
    assert {k: r["fp"] & (2 ** 64 - 1) for k, r in rows.items()} == dict(enumerate(fps))
    assert {k: r["component_id"] for k, r in rows.items()} == roots(list(range(len(texts))), fps)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_repeated_and_null_ids(spark):
    docs = make_docs(spark, ["a b c d", "a b c d", "q r s t u", None, ""], ids=[5, 5, None, 9, 2])
    rows = simhash.near_duplicates(docs, ["text"]).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in rows) == [(-1, None), (2, 2), (5, 5), (5, 5), (9, 2)]
    kept = simhash.first_of_id(docs, ["doc_id", "text", "fp"])
    assert kept.count() == 4


def test_clashing_names_and_very_long_texts(spark):
    long = " ".join(f"w{i * i % 9973}" for i in range(200_000))
    docs = make_docs(spark, ["a b c d", long, "x y z", long + " end"]).selectExpr("*", "7 component_id", "8 root", "9 node", "10 least", "text k")
    rows = simhash.near_duplicates(docs, ["fp", "component_id", "root", "node", "least", "doc_id"], with_root=True).collect()
    assert {(r["given_fp"], r["given_component_id"], r["given_root"], r["node"], r["least"]) for r in rows} == {(3, 7, 8, 9, 10)}
    assert all(r["given_doc_id"] == r["doc_id"] for r in rows) and len({r["root"] for r in rows}) == 3
    assert {r["doc_id"]: r["component_id"] for r in rows} == {0: 0, 1: 1, 2: 2, 3: 1}
    assert {r["doc_id"]: r["fp"] & (2 ** 64 - 1) for r in rows}[1] == fingerprint(long)


def test_groups_are_filed_again_in_one_plan(spark, capsys):
    entries = spark.createDataFrame([(i,) for i in range(40)], "fp long")
    simhash.fingerprint_links(entries, large=3).explain()
    assert capsys.readouterr().out.count("FlatMapGroupsInArrow") == 1
