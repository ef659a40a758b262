"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's score is the sum of shared weights over its hashed features.
Ordered thresholds cut the score into grades: P(grade <= k) = sigmoid(t_k -
score). The model gives the expected grade and the tail probability
P(grade >= chosen grade), by which documents are selected.

Grades come from ``labels``: 0 toxic, 1 low quality, 2 good. The fit takes a
bounded sample of the labelled documents (about ``max_rows``, by hash of the
id); scoring covers every whole text.

Features of a text, each hashed to one of 2^bits weights and counted once:

* its words (ASCII lower-cased, ASCII punctuation removed) and their first 5
  and 8 bytes;
* its shape: shares of symbols, separators, digits, capitals, exclamation
  marks, repeated and distinct words, repeated lines, and its length, each as
  the steps of a ladder that it passes.

Invented and rare words are most of a vocabulary and only add noise, so the
fit keeps a word feature only if it is in ``min_df`` sample documents and its
share of documents below the best grade differs from the sample's by
``min_z`` standard errors.

Defined results: a null or empty text has only its shape features; label
rows with a null id, quality or toxic value are not used, of several rows of
one document the lowest grade counts; without any label every document has
a tail probability of 1; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import asked_for, batches_of, fields, ship, small_batches, table, text_or_empty, written

ship(__name__)

MAX_ROWS = 20_000
BITS = 18
GRADES = 3
EPOCHS = 20
RATE = 0.1
L2 = 1e-6
SEED = 7
MIN_DF = 3
MIN_Z = 3.5
RESULTS = ("score", "expected_grade", "tail", "tail_probability", "selected")
PREFIXES = (5, 8)


class Features:
    """Hashed features of a text. Words seen before keep their features."""

    LADDERS = (
        (b"symbols", (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
        (b"bars", (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
        (b"digits", (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
        (b"capitals", (0.1, 0.2, 0.4, 0.8, 1.6, 3.2)),
        (b"shouts", (0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
        (b"again", (0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
        (b"top", (0.05, 0.08, 0.12, 0.2, 0.4)),
        (b"lines", (0.01, 0.05, 0.1, 0.2, 0.4)),
        (b"length", (0, 5, 10, 20, 40, 80, 160, 400, 1000)),
        (b"distinct", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
    )
    SYMBOLS = b"#*$%&|<>=~^{}[]\\_@+"
    KEPT_WORDS = 100_000  # words a task remembers

    def __init__(self, bits: int, wanted=None):
        """``wanted``: a bool array; other word features are left out."""
        import string
        from bisect import bisect_left
        from zlib import crc32
        self.mask, self.crc32, self.steps_passed, self.wanted = (1 << bits) - 1, crc32, bisect_left, wanted
        self.punctuation = string.punctuation.encode()
        self.capitals = string.ascii_uppercase.encode()
        self.seen: dict[bytes, tuple] = {}
        self.rungs = {name: [crc32(b"\0%s>%d" % (name, i)) & self.mask for i in range(len(cuts))] for name, cuts in self.LADDERS}

    def of_word(self, w: bytes) -> tuple:
        ids = {self.crc32(x) & self.mask for x in (w, *(b"%d\0" % n + w[:n] for n in PREFIXES))}
        return tuple(i for i in ids if self.wanted is None or self.wanted[i])

    def words(self, raw: bytes) -> set:
        seen, out = self.seen, set()
        for w in set(raw.lower().translate(None, self.punctuation).split()):
            ids = seen.get(w)
            if ids is None:
                if len(seen) >= self.KEPT_WORDS:
                    seen.clear()
                ids = seen[w] = self.of_word(w)
            if ids:
                out.update(ids)
        return out

    def shape(self, raw: bytes) -> list[int]:
        from collections import Counter
        words = raw.lower().split()
        n = len(words)
        per = max(1, n)
        of = lambda chars: (len(raw) - len(raw.translate(None, chars))) / per
        counts = Counter(words)
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        values = (
            of(self.SYMBOLS), sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()) / per,
            of(b"0123456789"), of(self.capitals), of(b"!"),
            sum(map(bytes.__eq__, words, words[1:])) / per, max(counts.values(), default=0) / per,
            1 - len(set(lines)) / max(1, len(lines)), n, len(counts) / per)
        out = []
        for (name, cuts), v in zip(self.LADDERS, values):
            out += self.rungs[name][:self.steps_passed(cuts, v)]
        return out


def screen(features: DataFrame, best: int, bits: int, min_df: int = MIN_DF, min_z: float = MIN_Z) -> list[int]:
    """The word features that tell documents below grade ``best`` from others.
    ``features``: grade and words (int32 bytes). Counts are made in tasks."""
    def count(batches):
        import numpy as np
        import pyarrow as pa
        n, low = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        for b in batches:
            for grade, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.frombuffer(words, dtype="<i4")
                n[ids] += 1
                if grade < best:
                    low[ids] += 1
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[ids]), pa.array(low[ids])], ["id", "n", "low"])

    r = features.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("grade") < best).cast("int")), F.lit(0)).alias("low")).first()
    p = (r["low"] + 0.5) / (r["n"] + 1)
    z = (F.col("low") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)))
    told = (features.select("grade", "words").mapInArrow(count, "id long, n long, low long").groupBy("id")
            .agg(F.sum("n").alias("n"), F.sum("low").alias("low")).where((F.col("n") >= min_df) & (F.abs(z) >= min_z)))
    return sorted(x["id"] for x in told.select("id").collect())


def fit(features: list, grades, bits: int = BITS, n_grades: int = GRADES, epochs: int = EPOCHS,
        rate: float = RATE, l2: float = L2, seed: int = SEED):
    """Weights and ordered thresholds by AdaGrad on mini-batches.
    ``features``: one int array per document."""
    import numpy as np
    rng = np.random.default_rng(seed)
    n, batch = len(grades), 64
    y = np.asarray(grades, dtype=np.int64)
    w, w2 = np.zeros(1 << bits), np.full(1 << bits, 1e-2)
    if not n:
        return w, np.full(n_grades - 1, -40.0)
    below = (np.cumsum(np.bincount(y, minlength=n_grades) + 1.0) / (n + n_grades))[:-1]
    cuts, cuts2 = np.log(below / (1 - below)), np.full(n_grades - 1, 1e-2)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
            ids = np.concatenate([features[i] for i in rows]).astype(np.int64)
            at = np.repeat(np.arange(len(rows)), [len(features[i]) for i in rows])
            score = np.bincount(at, w[ids], minlength=len(rows))
            edge = np.concatenate(([-np.inf], cuts, [np.inf]))
            with np.errstate(over="ignore"):
                hi = 1 / (1 + np.exp(score - edge[y[rows] + 1]))
                lo = 1 / (1 + np.exp(score - edge[y[rows]]))
            p = np.maximum(hi - lo, 1e-9)
            slope = 1 - hi - lo  # of -log p, by the score; at 0.5 between grades
            used, back = np.unique(ids, return_inverse=True)
            grad = np.bincount(back, slope[at], minlength=len(used)) / len(rows) + l2 * w[used]
            w2[used] += grad ** 2
            w[used] -= rate * grad / np.sqrt(w2[used])
            up, down = hi * (1 - hi) / p, lo * (1 - lo) / p
            grad = np.array([down[y[rows] == k + 1].sum() - up[y[rows] == k].sum() for k in range(n_grades - 1)]) / len(rows)
            cuts2 += grad ** 2
            cuts = np.sort(cuts - rate * grad / np.sqrt(cuts2))
    return w, cuts


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, grade) of the labelled documents."""
    grade = F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(grade).alias("grade")))


def train(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = MAX_ROWS, bits: int = BITS, n_grades: int = GRADES):
    """(weights, thresholds) from about ``max_rows`` graded documents. Their
    features are extracted in tasks; the fit itself runs on that sample."""
    import numpy as np
    small_batches(docs.sparkSession)
    n = grades.count()
    # Ids by a 62-bit hash: any share of them can be picked, however small.
    whole = 1 << 62
    pick = F.xxhash64("doc_id", F.lit(SEED)).bitwiseAND(F.lit(whole - 1)) < F.lit(whole * max_rows // max(1, n, max_rows))
    sample = grades.where(pick).select(F.col("doc_id").alias("__id"), "grade")

    def extract(batches):
        import numpy as np
        import pyarrow as pa
        f = Features(bits)
        for b in batches:
            col = b.column(1)
            for s, e in batches_of(col, 1 << 22):
                raw = [(t or "").encode("utf-8", "replace") for t in col.slice(s, e - s).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s, e - s), pa.array([np.array(sorted(f.words(x)), "<i4").tobytes() for x in raw], pa.binary()),
                     pa.array([np.array(f.shape(x), "<i4").tobytes() for x in raw], pa.binary())], ["grade", "words", "shape"])

    # The sample has about max_rows rows of 12 bytes, so it is broadcast. An id that
    # many rows share counts once, with the text of least hash (then least text):
    # the hash is found by an aggregate, so equal ids move one short row a task.
    texts = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("text")).join(F.broadcast(sample), "__id")
    texts = texts.withColumn("__hash", F.xxhash64("text"))
    chosen = texts.groupBy(F.col("__id").alias("__i")).agg(F.min("__hash").alias("__h"))
    one = (texts.join(F.broadcast(chosen), (F.col("__id") == F.col("__i")) & (F.col("__hash") == F.col("__h")))
           .groupBy("__id").agg(F.first("grade").alias("grade"), F.min("text").alias("text")))
    found = written(one.select("grade", "text").mapInArrow(extract, "grade int, words binary, shape binary"), "quality-sample")
    wanted = np.zeros(1 << bits, dtype=bool)
    wanted[screen(found, n_grades - 1, bits)] = True

    def narrow(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            both = []
            for words, shape in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                w = np.frombuffer(words, dtype="<i4")
                both.append(np.unique(np.concatenate((w[wanted[w]], np.frombuffer(shape, dtype="<i4")))).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(both, pa.binary())], ["grade", "ids"])

    # Only the screened features of the sample come to the driver: some dozens a row.
    rows = sorted(tuple(r) for r in found.mapInArrow(narrow, "grade int, ids binary").collect())
    weights, cuts = fit([np.frombuffer(x, dtype="<i4") for _, x in rows], [g for g, _ in rows], bits, n_grades)
    return weights, cuts, wanted


def score(docs: DataFrame, model, columns: list[str], text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``columns`` of every document and: score, expected_grade double,
    tail array<double> (P(grade >= k) for k = 1, 2, ...). A column named like
    a result of this or of ``rated`` is returned as ``given_<name>``."""
    spark = docs.sparkSession
    small_batches(spark)
    # 2^bits weights and flags: a fixed 2.25 MB.
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        weights, cuts, wanted = held.value
        f = Features(bits, wanted.tolist())
        w = weights.tolist()
        for b in batches:
            text = b.column(b.num_columns - 1)
            for s, e in batches_of(text, 1 << 22):
                part = b.slice(s, e - s)
                sums = []
                for t in part.column(b.num_columns - 1).to_pylist():
                    raw = (t or "").encode("utf-8", "replace")
                    ids = f.words(raw)
                    ids.update(f.shape(raw))
                    sums.append(sum(w[i] for i in sorted(ids)))
                sums = np.array(sums)
                with np.errstate(over="ignore"):
                    tail = 1 / (1 + np.exp(cuts[None, :] - sums[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(sums), pa.array(tail.sum(axis=1)), pa.array(list(tail), pa.list_(pa.float64()))],
                    [*part.schema.names[:-1], "score", "expected_grade", "tail"])

    given = docs.select(*asked_for(columns, RESULTS), text_or_empty(text_col).alias("__text"))
    return given.mapInArrow(run, fields(given, given.columns[:-1], "score double, expected_grade double, tail array<double>"))


def rated(docs: DataFrame, labels: DataFrame, columns: list[str], grade: int = GRADES - 1, least: float = 0.5, **kw) -> DataFrame:
    """``columns`` of every document with score, expected_grade, tail_probability
    (of ``grade`` or better) and selected (tail_probability >= ``least``)."""
    model = train(docs, graded(labels), **kw)
    s = score(docs, model, columns, text_col=kw.get("text_col", "text"))
    return (s.withColumn("tail_probability", F.col("tail")[grade - 1]).drop("tail")
            .withColumn("selected", F.col("tail_probability") >= least))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return r.withColumnRenamed("selected", "kept")
