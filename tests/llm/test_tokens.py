import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelwise.llm import token_counts, token_store, tokens

from .conftest import make_docs, some_texts

ODD = ["", " ", "  a", "a  b", "a \n b", "x  y", "end ", "\n", "\nx", "a\n\nb  c", "<|endoftext|> hi", "a <|endoftext|>", "x<|endoftext|><|endoftext|> y\n<|endoftext|>", "<|endoftext| >", " lead", "tab\t tab",
       "日本 語 テ", "a\x1c b", "a  b", "é x", "a b c", "it's we'll\nI'd", "😀 x", "\r\n x", "a\n b"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def as_ids(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def test_byte_bpe_equals_library(library):
    texts = ODD + [t or "" for t in some_texts()]
    enc = tokens.ByteBpe(tokens.tokenizer_path())
    assert [as_ids(x) for x in enc.encode(texts)] == library(texts)
    assert as_ids(enc.encode(["<|endoftext|> hi"])[0]) == [50256, 23105]
    enc.cache.limit = 5  # generations change all the time
    for t, want in zip(texts * 2, library(texts) * 2):
        assert as_ids(enc.encode([t])[0]) == want


def test_store_round_trip(spark, library, tmp_path):
    texts = some_texts()
    ids = [3 * i - 20 for i in range(len(texts))]
    ids[4], ids[5], ids[6] = ids[3], None, None  # equal and null keys
    docs = make_docs(spark, texts, ids=ids)
    path = f"{tmp_path}/store"
    token_store.write_tokens(docs, path, shard_bytes=900, part_bytes=2000, bucket_keys=7)
    got = sorted(token_store.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == len(texts)
    order = [r["key"] for r in got]
    assert order == sorted(ids, key=lambda k: (k is not None, k or 0))
    start, want = 0, {}
    for k, t in zip(ids, texts):
        want.setdefault(k, []).append(library([t or ""])[0] + [0])
    for r in got:
        assert r["start"] == start and r["n"] * 4 == len(r["ids"])
        assert as_ids(r["ids"]) in want[r["key"]]
        start += r["n"]
    asked = spark.createDataFrame([(k,) for k in ids + [10 ** 9, 7]] + [(ids[0],)], "key long")
    found = token_store.lookup(spark, path, asked).collect()
    assert sorted((r["key"], r["start"], r["ids"]) for r in found) == sorted((r["key"], r["start"], r["ids"]) for r in got if r["key"] is not None)
    by_index = {(r["key"], r["start"], r["n"], r["ids_crc32"]) for r in token_store.indexed_documents(spark, path).collect()}
    assert by_index == {(r["key"], r["start"], r["n"], zlib.crc32(r["ids"])) for r in got}


def test_a_key_in_many_shards_and_parts(spark, library, tmp_path):
    texts = [f"word{i} " * 30 for i in range(200)]
    ids = [5] * 120 + list(range(10, 90))
    path = f"{tmp_path}/store"
    token_store.write_tokens(make_docs(spark, texts, ids=ids), path, shard_bytes=600, part_bytes=4000, bucket_keys=9)
    places = token_store.spans(spark, path, spark.createDataFrame([(5,)], "key long"))
    assert places.select("part").distinct().count() > 1 and places.count() > 5
    got = token_store.lookup(spark, path, spark.createDataFrame([(5,), (11,)], "key long")).collect()
    assert sorted(as_ids(r["ids"]) for r in got) == sorted(library([t])[0] + [0] for t, i in zip(texts, ids) if i in (5, 11))


def test_one_key_reads_one_part(spark, tmp_path):
    path = f"{tmp_path}/store"
    token_store.write_tokens(make_docs(spark, [f"text {i} " * 50 for i in range(100)]), path, part_bytes=3000)
    parts = spark.read.parquet(f"{path}/parts").count()
    found = token_store.lookup(spark, path, spark.createDataFrame([(40,)], "key long"))
    place = token_store.spans(spark, path, spark.createDataFrame([(40,)], "key long")).collect()
    scans = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "payload" in x]
    assert parts > 5 and len(place) == 1 and len(scans) == 1
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", scans[0]).group(1)
    assert re.search(rf"part#\d+ = {place[0]['part']}\)", filters) and found.count() == 1


def test_very_long_text(spark, library, tmp_path):
    long = "".join(f"w{i % 7919}, " for i in range(150_000))
    path = f"{tmp_path}/store"
    token_store.write_tokens(make_docs(spark, ["a", long, None]), path, shard_bytes=1000)
    got = {r["key"]: as_ids(r["ids"]) for r in token_store.read_documents(spark, path).collect()}
    assert got == {0: library(["a"])[0] + [0], 1: library([long])[0] + [0], 2: [0]}


def test_store_of_no_documents(spark, no_docs, tmp_path):
    token_store.write_tokens(no_docs, f"{tmp_path}/store")
    assert token_store.read_documents(spark, f"{tmp_path}/store").count() == 0
    asked = spark.createDataFrame([(1,)], "key long")
    assert token_store.lookup(spark, f"{tmp_path}/store", asked).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 20000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-2 ** 62, 2 ** 62, n))
    levels = token_store.build_hash(keys)
    assert sorted(token_store.hash_numbers(levels, keys)) == list(range(len(keys)))
    assert sum(m for m, _ in levels) <= 64 * len(levels) + 6 * len(keys)


def test_store_query_on_small_tables(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in token_store.op2_token_store(spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(library([r["text"] or ""])[0] + [0], dtype="<u4")
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_histogram_answers(spark, library):
    texts = some_texts()
    lens = sorted(len(x) for x in library([t or "" for t in texts]))
    h = token_counts.length_histogram(token_counts.token_lengths(make_docs(spark, texts)), block=8)
    rows = {r["length"]: r for r in h.collect()}
    assert sorted(x for k, r in rows.items() for x in [k] * r["n_docs"]) == lens
    for k, r in rows.items():
        assert r["docs_at_least"] == sum(x >= k for x in lens) and r["tokens_at_least"] == sum(x for x in lens if x >= k)
        assert r["truncated_total"] == sum(min(x, k) for x in lens)
        assert abs(r["share_up_to"] - sum(x <= k for x in lens) / len(lens)) < 1e-12
    for limit in (0, 1, 5, 17, 10 ** 6):
        assert token_counts.truncated_total(h, limit) == sum(min(x, limit) for x in lens)
    assert token_counts.quantile(h, 0.5) == lens[(len(lens) + 1) // 2 - 1]
    assert token_counts.totals(h).first()["n_tokens"] == sum(lens)


def test_histogram_with_the_end_id(spark, library):
    texts = some_texts() + ["<|endoftext|>"]
    h = token_counts.length_histogram(token_counts.token_lengths(make_docs(spark, texts), end_id=True))
    want = sorted(len(x) + 1 for x in library([t or "" for t in texts]))
    assert sorted(x for r in h.collect() for x in [r["length"]] * r["n_docs"]) == want
    assert h.agg({"n_tokens": "sum"}).first()[0] == sum(want)


def test_histogram_of_nothing(no_docs):
    h = token_counts.length_histogram(token_counts.token_lengths(no_docs))
    assert h.count() == 0 and token_counts.quantile(h, 0.5) is None and token_counts.truncated_total(h, 9) == 0


def test_words_with_marks_equal_library_and_skip_its_splitting(library):
    words = ["naïve", "ŁÓDŹ", "ªº", "ǅungla", "ɏz", "ɐz", "ﬁx", "x1", "a_b", "don't", "rock'", "x!", "x!?", "(x)", "x'!", "a.b", "µm,", "x­", "ß;;", "é—", "aё", "Ab~`", "x̀", "1,"]
    texts = [f"{a} {b}\n{a}{b} {b}\n{b},{a} {a}." for a in words for b in words]
    texts += ["h " + " ".join(f"zq{chr(97 + i % 26)}{chr(97 + i // 26)}{'áé'[i % 2]}{'!' * (i % 5)}" for i in range(600))]
    enc = tokens.ByteBpe(tokens.tokenizer_path())
    want = library(texts)
    assert [as_ids(x) for x in enc.encode(texts)] == want
    enc.cache.young, enc.cache.old = {}, {}
    handed, ids = [], enc._ids
    enc._ids = lambda asked: (handed.extend(asked), ids(asked))[1]
    assert as_ids(enc.encode(texts[-1:])[0]) == want[-1]
    assert sum(map(len, handed)) < 20 < len(texts[-1])  # the first word only, and no words of letters
    import pyarrow as pa
    assert [bytes(x) for x in enc.encode(pa.array(["", *texts]).slice(1))] == [bytes(x) for x in enc.encode(texts)]
