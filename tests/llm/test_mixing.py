from collections import defaultdict

from panelwise.llm import mixing

from .conftest import make_docs


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_targets_share_the_excess(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 90)], "source string, size long")
    t = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    # Weights by code point, null last: a 3, b 1, c 2, null 3; 150% of 2100 is 3150.
    assert t["a"] == 20 and t[None] == 180
    assert t["c"] == 1966 + 2 / 3 and t["b"] == 983 + 1 / 3
    assert abs(sum(t.values()) - 3150) < 1e-6


def test_targets_all_capped(spark):
    sized = spark.createDataFrame([("a", 5), ("b", 0)], "source string, size long")
    t = {r["source"]: r["target"] for r in mixing.source_targets(sized, share=3.0).collect()}
    assert t == {"a": 10.0, "b": 0.0}


def test_mix_follows_queue_order(spark):
    import random
    rng = random.Random(5)
    docs = make_docs(spark, ["w " * rng.randint(0, 30) for _ in range(400)], sources=["s1", "s1", "s1", "s2", "s3", None])
    got = by_id(mixing.mix(docs))
    queue = {r["doc_id"]: r for r in mixing.queue_positions(docs).collect()}
    # One queue after another, all finish times sorted, cut at the budget.
    per = defaultdict(list)
    for r in queue.values():
        per[r["source"]].append(r)
    turns = []
    for source, rs in per.items():
        size = sum(r["size"] for r in rs)
        target = got[rs[0]["doc_id"]]["target"]
        done = 0
        for turn in (0, 1):
            for r in sorted(rs, key=lambda r: (r["spot"], r["doc_id"])):
                done += r["size"]
                if r["size"]:
                    turns.append((done / target, source is None, source or "", r["spot"], r["doc_id"], r["size"]))
        assert all(got[r["doc_id"]]["source_size"] == size for r in rs)
    budget, taken, copies = 1.5 * sum(r["size"] for r in queue.values()), 0, defaultdict(int)
    for t in sorted(turns):
        taken += t[-1]
        if taken > budget:
            break
        copies[t[4]] += 1
    assert {k: v["copies"] for k, v in got.items()} == {k: copies[k] for k in got}
    for source, rs in per.items():
        took = sum(got[r["doc_id"]]["size"] * got[r["doc_id"]]["copies"] for r in rs)
        assert abs(took - got[rs[0]["doc_id"]]["target"]) <= 60


def test_repeated_rows_share_their_turns(spark):
    docs = make_docs(spark, ["one two"] * 6 + ["a b c d"] * 3, ids=[1] * 6 + [2, 3, None], sources=["s"])
    rows = mixing.mix(docs).collect()
    assert len(rows) == 9 and sum(r["size"] * r["copies"] for r in rows) <= 36
    assert mixing.mixed_documents(docs).columns == docs.columns


def words_of(rows):
    return sum(len((r["text"] or "").split()) for r in rows)


def test_documents_returned_are_the_words_taken(spark, monkeypatch):
    texts = ["five words are in here"] * 50 + [f"w{i} " * (i + 1) for i in range(10)] + [None, ""]
    docs = make_docs(spark, texts, ids=[1] * 50 + list(range(2, 12)) + [12, 13], sources=["s"]).repartition(4)
    monkeypatch.setattr(mixing, "RUN", 7)  # equal rows in several runs
    taken = mixing.mix(docs).collect()
    out = mixing.mixed_documents(docs).collect()
    assert len(taken) == 62 and words_of(out) == sum(r["size"] * r["copies"] for r in taken)
    assert words_of(out) <= 1.5 * words_of(docs.collect())
    per = defaultdict(int)
    for r in taken:
        per[r["doc_id"]] += r["copies"] if r["size"] else 1
    got = defaultdict(int)
    for r in out:
        got[r["doc_id"]] += 1
    assert dict(got) == {k: n for k, n in per.items() if n}
    twins = sorted(r["copies"] for r in taken if r["doc_id"] == 1)
    assert twins[-1] - twins[0] <= 1


def test_a_hot_id_is_spread(spark):
    n = 6000
    docs = make_docs(spark, [f"a b {i}" for i in range(n)], ids=[9 if i % 3 == 0 else None if i % 3 == 1 else i for i in range(n)], sources=["s"])
    parts = int(n ** 0.5)
    span = -(-16 ** 6 // parts)
    per = defaultdict(int)
    for r in mixing.queue_positions(docs).collect():
        per[int(r["spot"][:6], 16) // span] += 1
    assert max(per.values()) < 5 * n / parts


def test_clashing_names_and_very_long_texts(spark):
    docs = make_docs(spark, ["x " * 500_000, "a b", "c"], sources=["s", "s", "t"]).selectExpr("*", "1 as twins", "2 as won", "3 as at", "4 as row", "5 as spot")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert all((r["twins"], r["won"], r["at"], r["row"], r["spot"]) == (1, 2, 3, 4, 5) for r in out.select("twins", "won", "at", "row", "spot").collect())
    assert words_of(out.collect()) <= 1.5 * 500_003


def test_empty_and_edge_texts(docs, no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    r = by_id(mixing.mix(docs))
    assert len(r) == docs.count() and all(v["copies"] <= 2 for v in r.values())
    assert all(v["copies"] == 0 for v in r.values() if v["size"] == 0)
    again = by_id(mixing.mix(docs))
    assert r == again
