import math
import re
from collections import Counter

import pytest

from panelwise.llm import lexical

from .conftest import some_texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_the_book(docs, items, top=20):
    """docs, items: lists of (id, text). Per item the (doc_id, score) list."""
    of = [(i, Counter(terms(t))) for i, t in docs]
    of = [(i, c, sum(c.values())) for i, c in of if c]
    N, L = len(of), sum(n for _, _, n in of)
    df = Counter(t for _, c, _ in of for t in c)
    out = []
    for item, text in items:
        score = []
        for i, c, n in of:
            m = 100 - 25 + (25 * n * N) // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                score.append((-s, i is None, i, s))
        out.append((item, [(i, s) for _, _, i, s in sorted(score, key=lambda x: (x[0], x[1], x[2] or 0))[:top]]))
    return out


def tables(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score long, rank long"),
            spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, local long"))


def check(spark, docs, items, **kw):
    got = {}
    for r in lexical.ranked(*tables(spark, docs, items), **kw).collect():
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    want = {i: [(k + 1, d, s) for k, (d, s) in enumerate(found)] for i, found in by_the_book(docs, items, kw.get("top", 20)) if found}
    assert {i: sorted(x) for i, x in got.items()} == want


def test_terms():
    text = "Don't \x00A-b_c9 É日本 x É\u0080 Z"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("kw", [{}, {"max_terms": 0}, {"chunk_docs": 7, "group_docs": 20, "bundle_items": 2}, {"rare": (20, 10, 4, 2)}])
def test_equals_brute_force(spark, kw):
    texts = some_texts(150)
    docs = list(enumerate(texts))
    items = [(k, texts[k * 7]) for k in range(9)] + [(50, "the the LAKE"), (51, "nothing-here"), (52, None), (53, ""), (54, "日本 é word")]
    check(spark, docs, items, **kw)


def test_ties_go_by_id_and_repeated_ids_stay(spark):
    docs = [(k * 37 % 101, "same words here") for k in range(101)] + [(200 + k, "other text") for k in range(50)]
    check(spark, docs, [(1, "same words"), (2, "text")], chunk_docs=10, group_docs=30)
    twice = lexical.ranked(*tables(spark, [(1, "a b"), (1, "a b"), (None, "a"), (None, "c")], [(9, "a")]), rare=(1,)).collect()
    assert sorted(r["rank"] for r in twice) == [1, 2, 3] and Counter(r["doc_id"] for r in twice) == {1: 2, None: 1}


def test_frequent_terms_and_long_texts(spark):
    docs = [(k, f"the common words w{k % 40}") for k in range(900)] + [(1000, "the long " + " ".join(f"v{k % 5000}" for k in range(150_000)))]
    check(spark, docs, [(1, "the common w3"), (2, "v17 v18 the the"), (3, "the")], chunk_docs=64, group_docs=200)


def test_text_ids(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    q = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r["rank"], r["doc_id"]) for r in sorted(lexical.ranked(d, q, rare=()).collect())] == [(1, "a"), (2, "b"), (3, None)]


def test_empty(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a")]
    none_d, none_i = tables(spark, docs, items)
    assert lexical.ranked(none_d.limit(0), none_i).count() == 0
    assert lexical.ranked(none_d, none_i.limit(0)).count() == 0
    assert lexical.ranked(none_d.where("text is null"), none_i).count() == 0
