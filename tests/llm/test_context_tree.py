import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from panelwise.llm import context_tree as ct

from .conftest import make_docs, some_texts


class Tree:
    """Context-tree weighting by the book: a node per context and bit path,
    whose weighted probability is computed from its children."""

    def __init__(self, depth):
        self.depth, self.count, self.kids = depth, defaultdict(lambda: [0, 0]), defaultdict(set)

    def paths(self, seq, i):
        for k in range(8):
            bits = seq[i] >> (8 - k) if k else 0
            yield k, bits, seq[i] >> (7 - k) & 1

    def learn(self, seq):
        for i in range(self.depth, len(seq)):
            for k, bits, bit in self.paths(seq, i):
                for d in range(self.depth + 1):
                    c = tuple(seq[i - d:i])
                    self.count[c, k, bits][bit] += 1
                    if d:
                        self.kids[c[1:], k, bits].add((c, k, bits))

    def kt(self, node):
        a, b = self.count[node] if node in self.count else (0, 0)
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weight(self, node, cache):
        if node not in cache:
            own = self.kt(node)
            if len(node[0]) < self.depth:
                below = sum(self.weight(x, cache) for x in self.kids.get(node, ()))
                both = max(own, below) + math.log(.5 * math.exp(own - max(own, below)) + .5 * math.exp(below - max(own, below)))
                cache[node] = both
            else:
                cache[node] = own
        return cache[node]

    def log10(self, seq, cache):
        total = 0.0
        for i in range(self.depth, len(seq)):
            for k, bits, bit in self.paths(seq, i):
                p = None
                for d in range(self.depth, -1, -1):
                    node = (tuple(seq[i - d:i]), k, bits)
                    a, b = self.count[node] if node in self.count else (0, 0)
                    own = ((b if bit else a) + .5) / (a + b + 1)
                    if d == self.depth:
                        p = own
                    else:
                        share = math.exp(self.kt(node) + math.log(.5) - self.weight(node, cache))
                        p = share * own + (1 - share) * p
                total += math.log10(p)
        return total


def expected(texts, ids):
    seqs = [bytes([255] * ct.DEPTH) + (t or "").encode().lower() + b"\xff" for t in texts]
    out = [crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in ids]
    tree, words = Tree(ct.DEPTH), Counter()
    for t, s, o in zip(texts, seqs, out):
        if not o:
            tree.learn(s)
            words.update((t or "").encode().lower().split() + [None])
    total, distinct, cache, rows = sum(words.values()), len(words), {}, []
    for t, s, o in zip(texts, seqs, out):
        ws = (t or "").encode().lower().split() + [None]
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in ws)
        rows.append((o, len(ws), sum(words[w] > 0 for w in ws), total, base, tree.log10(s, cache)))
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_against_brute_force(spark, block_bytes):
    texts = some_texts(20, words=25)
    ids = [*range(100, 100 + len(texts) - 1), None]
    docs = make_docs(spark, texts, ids=ids)
    got = {r["doc_id"]: r for r in ct.scores(docs, ["doc_id", "part"], block_bytes=block_bytes).collect()}
    assert any(r["held_out"] for r in got.values())
    for i, want in zip(ids, expected(texts, ids)):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:4]
        assert math.isclose(r["base_score"], want[4], rel_tol=1e-9)
        assert math.isclose(r["score"], want[5], rel_tol=1e-9), (i, r["score"], want[5])
        assert math.isclose(r["bits_per_byte"], -r["score"] * math.log2(10) / r["n_bytes"])


def test_messages_are_exact_and_small():
    from panelwise.llm import blocks
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 56, 5000, dtype=np.uint64))
    for k in (keys, keys[:1], keys[:0], np.concatenate([keys, np.array([2 ** 64 - 1], dtype=np.uint64)])):
        assert (blocks.unpacked_keys(blocks.packed_keys(k)) == k).all()
    near = np.cumsum(rng.integers(1, 5000, 100_000)).astype(np.uint64)
    assert len(blocks.packed_keys(near)) < 2.2 * len(near)
    counts = rng.integers(0, 300, 1000).astype("<u4")
    assert (blocks.unpacked(blocks.packed(counts), "<u4") == counts).all() and len(blocks.unpacked(None, "<u4")) == 0
    x = -rng.exponential(2, 1000)
    assert np.allclose(ct.as_doubles(ct.rounded(x)), x, rtol=2.0 ** -36, atol=0)


def test_long_text_and_equal_rows(spark):
    long = "".join(f"word{i % 977} " for i in range(120_000))
    docs = make_docs(spark, [long, "a b", "a b", None], ids=[1, 2, 2, 3])
    got = ct.scores(docs, ["doc_id", "text"]).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 3, 3, 120_001]
    twins = [r for r in got if r["doc_id"] == 2]
    assert twins[0]["score"] == twins[1]["score"] and all(r["score"] < 0 for r in got)


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(0)
    seq = rng.integers(97, 101, 3000).astype(np.uint8)
    keys, counts = np.unique(ct.gram_keys(seq), return_counts=True)
    context = int(keys[7]) >> 8
    every = np.unique(np.concatenate([keys, np.array([context << 8 | b for b in range(256)], np.uint64)]))
    n = np.zeros(len(every), dtype=np.int64)
    n[np.searchsorted(every, keys)] = counts
    p = 10 ** ct.gram_log10(every, n, ct.Top(np.zeros((256, 256)), np.zeros((256, 256))))
    assert math.isclose(p[(every >> np.uint64(8)) == context].sum(), 1, rel_tol=1e-9)


def test_log_gamma():
    x = np.array([.5, 1, 1.5, 2, 7.9, 8, 30.5, 1e6, 1e12])
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_edges(spark, no_docs):
    assert ct.scores(no_docs, ["doc_id"]).count() == 0
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    r = ct.scores(make_docs(spark, ["ab"], ids=[held]), ["doc_id"]).first()  # nothing to learn from
    assert r["train_tokens"] == 0 and r["base_score"] == 0 and math.isclose(r["score"], 24 * math.log10(.5), rel_tol=1e-6)


def test_contexts_of_six_bytes_are_learnt(spark):
    rng = np.random.default_rng(8)
    texts = ["".join(("xabcde1 ", "yabcde2 ")[i] for i in rng.integers(0, 2, 150)) for _ in range(60)]
    got = [r for r in ct.scores(make_docs(spark, texts), ["doc_id"]).collect() if r["held_out"]]
    # One free bit in eight bytes; a second one if the x or y is out of sight.
    assert got and all(r["bits_per_byte"] < 0.19 for r in got)


def test_clashing_names(spark, docs):
    from panelwise.llm import context_tree
    given = docs.selectExpr("doc_id", "text", "'own' score", "1 n_bytes", "2 held_out")
    out = context_tree.scores(given, ["doc_id", "score", "n_bytes", "held_out"])
    assert out.columns[:4] == ["doc_id", "given_score", "given_n_bytes", "given_held_out"]
    rows = out.collect()
    assert len(rows) == docs.count() and all((r["given_score"], r["given_n_bytes"], r["given_held_out"]) == ("own", 1, 2) for r in rows)
    assert all(r["score"] < 0 for r in rows)
