"""A training corpus from ``documents``: quality classifier, near-duplicates,
long repeats, source mix, SentencePiece ids.

Each stage works on all rows its predecessor kept, reads them from a written
table and returns the columns of ``documents``; the last one returns ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwise.llm import common, mixing, pieces, quality, simhash, suffixes
from panelwise.session import scratch_path

REST = "__rest"


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the other columns as one struct: whatever they are
    called, they cannot clash with an operator's own columns."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]).alias(REST))


def _unpacked(packed: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` again, those in ``new`` replaced."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    return packed.select(*[new.get(c, own.get(c, F.col(REST)[c])).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is at least one half."""
    labels = common.table(spark, sf_dir, "labels")
    return _unpacked(quality.rated(_packed(docs), labels, ["doc_id", "text", REST]).where("selected"), docs)


def simhash_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the
    smallest id, of rows with that id the first in order of text and the other
    columns. Rows of equal or null ids that are no near-duplicates all stay."""
    found = simhash.near_duplicates(_packed(docs), ["text", REST], with_root=True)
    own = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return _unpacked(simhash.first_of_id(own, ["root", "doc_id", "text", REST], "root"), docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of long repeats. A character that lost a byte
    goes whole; n_chars is counted again, and documents with nothing left go."""
    cut = suffixes.repeats(_packed(docs), ["doc_id", "text", REST])
    whole = F.col("n_removed") == 0
    left = cut.withColumn("__left", F.when(~whole, suffixes.whole_characters(F.col("kept"))))
    left = left.where(whole | (F.length(F.trim("__left")) > 0))
    count = F.when(whole, F.col(REST)["n_chars"]).otherwise(F.char_length("__left").cast("long"))
    return _unpacked(left, docs, text=F.when(whole, F.col("text")).otherwise(F.col("__left")), n_chars=count)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken twice appears twice."""
    packed = _packed(docs).withColumn("__source", F.col(REST)["source"])
    return _unpacked(mixing.mixed_documents(packed, source_col="__source"), docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document: doc_id, source, n_tokens, ids, ends, and whether
    the ids decode to the text."""
    e = pieces.encoded(docs, ["doc_id", "source", "text"])
    return e.select("doc_id", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "ends",
                    (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_duplicates),
    ("suffix-array dedup", suffix_dedup),
    ("source mix", mix_sources),
    ("sentencepiece", sentencepiece),
]

# A fitted classifier and piece ids are beyond SQL; tests/llm compares the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{k}")
    return docs
