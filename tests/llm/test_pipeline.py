import random

import numpy as np
import sentencepiece as sp
from pyspark.sql import functions as F

import corpus_pipeline as cp
from panelwise.llm import mixing, pieces, quality

from .conftest import SCHEMA

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
from .test_simhash import fingerprint, roots
from .test_suffixes import brute


def tables(spark, path):
    rng = random.Random(9)
    fill = [f"word{i}" for i in range(250)]
    prose = lambda n: " ".join(rng.choice(fill) for _ in range(n))
    shared = prose(60)
    texts = [prose(rng.randint(30, 80)) for _ in range(150)]
    texts += [f"{prose(30)} {shared} {prose(20)}" for _ in range(6)] + [texts[3]] * 4
    texts += [prose(30) + " vile " + prose(20) + " nasty filth" for _ in range(40)] + [None, "", " \n"]
    rows = [(i, t, "en", rng.choice(["s0", "s1", "s2", None]), len(t or ""), 1, 2, 3, 4) for i, t in enumerate(texts)]
    labels = [(i, 1, int("vile" in (t or ""))) for i, t in enumerate(texts) if i % 3]
    spark.createDataFrame(rows, SCHEMA).select(*COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def test_every_stage_by_brute_force(spark, tmp_path):
    sf = str(tmp_path / "sf")
    given = {r[0]: r for r in tables(spark, sf)}
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, sf)
        if k < len(cp.STAGES) - 1:
            assert out.columns == COLUMNS and out.schema == docs.schema
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(sorted(docs.collect(), key=lambda r: r["doc_id"]))
    good, unique, cut, mixed, ids = seen

    kept = {r["doc_id"] for r in good}
    toxic = {i for i, r in given.items() if "vile" in (r[1] or "")}
    assert not kept & toxic and len(kept) >= 0.97 * (len(given) - len(toxic) - 3)
    model = quality.train(spark.read.parquet(f"{sf}/documents.parquet"), quality.graded(spark.read.parquet(f"{sf}/labels.parquet")))
    assert model[0].any()

    own = roots([r["doc_id"] for r in good], [fingerprint(r["text"]) for r in good])
    assert [r["doc_id"] for r in unique] == sorted(set(own.values()))

    left = brute([r["text"] for r in unique], 200)
    want = {}
    for r, (n, gone, _, rest) in zip(unique, left):
        text = rest.decode("utf-8", "ignore") if gone else r["text"]
        if not gone or text.strip(" "):
            want[r["doc_id"]] = (text, len(text) if gone else r["n_chars"])
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut} == want
    assert any(g for _, g, _, _ in left)

    copies = {r["doc_id"]: r["copies"] if r["size"] else 1 for r in mixing.mix(spark.read.parquet(f"{tmp_path}/2")).collect()}
    assert sorted(r["doc_id"] for r in mixed) == sorted(i for i, n in copies.items() for _ in range(n))

    library = sp.SentencePieceProcessor(model_file=pieces.model_path())
    texts = {r["doc_id"]: r["text"] or "" for r in mixed}
    assert [r["doc_id"] for r in ids] == [r["doc_id"] for r in mixed]
    for r in ids:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["round_trip"]


def test_simhash_stage_keeps_unlinked_rows_of_one_id(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(40)) for _ in range(8)]
    given = [(None, 0), (None, 1), (None, 2), (None, 2), (7, 3), (7, 4), (7, 4), (9, 5), (3, 5), (None, 5), (7, 6), (5, 6), (7, 7)]
    docs = spark.createDataFrame([(i, texts[t], "en", "s", k) for k, (i, t) in enumerate(given)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = cp.simhash_duplicates(spark, docs, "/root/testdata/sf0.001").collect()
    want = [(None, 0), (None, 1), (None, 2), (7, 3), (7, 4), (3, 5), (5, 6), (7, 7)]
    assert sorted((r["doc_id"] or 0, texts.index(r["text"])) for r in out) == sorted((i or 0, t) for i, t in want)


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    out = cp.run(spark, sf)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "ends", "round_trip"] and out.count() > 0
    assert out.where("not round_trip").count() == 0


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    sf = str(tmp_path / "sf")
    tables(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["score", "selected", "kept", "fp", "n_removed", "copies", "size", "ids", "tail", "block", "part", "component_id", "a-b", "target"]
    for i, n in enumerate(names):
        docs = docs.withColumn(n, F.when(F.col("doc_id") % 2 == 0, F.lit(i)))
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() > 0
        assert out.where("doc_id % 2 = 0 and (score <> 0 or kept <> 2 or `a-b` <> 12 or target <> 13)").count() == 0
    assert cp.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_stages_take_empty_tables(spark, no_docs):
    docs = no_docs.select(*COLUMNS)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
