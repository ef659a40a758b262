import random
from collections import Counter

import pytest

from panelwise.llm import suffixes

from .conftest import make_docs, some_texts


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone) if not g)))
    return out


def got(docs, **kw):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffixes.repeats(docs, ["doc_id"], **kw).collect()}


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(4)
    line = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [line(n) for n in (199, 200, 201, 260, 900)]
    texts = some_texts() + [line(rng.randint(0, 500)) for _ in range(30)]
    for p in shared:
        texts += [line(rng.randint(0, 90)) + p + line(rng.randint(0, 90)) for _ in range(4)] + [p[:150] + line(5) + p[150:]]
    texts += [shared[4] + "!" + shared[4], "ab" * 300, "x" * 1000, "é" * 250, shared[3], shared[3]]
    assert got(make_docs(spark, texts), block_bytes=block_bytes) == dict(enumerate(brute(texts, 200)))


def test_long_texts_are_cut_into_ranges(spark, monkeypatch):
    rng = random.Random(6)
    long_ = "".join(rng.choice("abcdefgh") for _ in range(9000))
    texts = [long_, "q" + long_[3100:3600], long_[8000:] + long_[:700], "short"]
    small = lambda lengths, length: _chunks(lengths, length, 1000)
    _chunks = suffixes.chunks
    monkeypatch.setattr(suffixes, "chunks", small)
    assert got(make_docs(spark, texts)) == dict(enumerate(brute(texts, 200)))


def test_other_lengths_and_edges(spark, no_docs):
    texts = ["abcabcabcab" * 4, None, "", "zz", "the same eight words are here twice over", "and the same eight words are here twice over"]
    assert got(make_docs(spark, texts), length=20, q=8) == dict(enumerate(brute(texts, 20)))
    assert suffixes.repeats(no_docs, ["doc_id", "block"]).count() == 0
    same = make_docs(spark, ["k" * 300, "k" * 300], ids=[1, 1])
    assert [r["n_removed"] for r in suffixes.repeats(same, ["doc_id", "part"]).collect()] == [300, 300]


def test_whole_characters(spark):
    raw = "aé日😀b".encode()
    cuts = [raw[i:j] for i in range(len(raw)) for j in range(i, len(raw) + 1)]
    df = spark.createDataFrame([(bytearray(c),) for c in cuts], "kept binary").select("kept", suffixes.whole_characters(__import__("pyspark").sql.functions.col("kept")).alias("t"))
    for r in df.collect():
        assert r["t"] == bytes(r["kept"]).decode("utf-8", "ignore")
