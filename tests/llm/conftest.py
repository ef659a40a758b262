import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, size long, fp long, part long"
# block, size, fp and part are also names that operators use inside.


def make_docs(spark, texts, sources=None, ids=None):
    rows = [(ids[i] if ids else i, t, "en", (sources or ["a", "b", None])[i % len(sources or "abc")],
             len(t) if t is not None else None, 1, 2, 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def some_texts(n=40, seed=3, words=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "Ärger", "naïve", "日本", "don't", "x1", "idiot", "tree", "lake", "stone", "A", "é", "\t", "z,", "(q)"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, words))) for _ in range(n)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(90))
    texts += [texts[0], texts[0], passage, "a b c " + passage + " end", passage[7:] + "\n" + texts[1], "", None, "  ", "\n\n", "word " * 400]
    return texts


@pytest.fixture
def docs(spark):
    return make_docs(spark, some_texts())


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
