"""Token counts from an exact length histogram.

Documents are encoded, their lengths counted, and suffix sums over the
histogram answer totals, quantiles and truncated totals for every context
limit without reading the documents again.

Defined results: a null or empty text has length 0 (or 1 with an end id);
an empty table gives an empty histogram, total 0 and null quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import batches_of, ship, small_batches, table, text_or_empty, written
from .tokens import byte_bpe, tokenizer_path

ship(__name__)

BLOCK = 1024  # lengths per block of the two-step suffix sums


def token_lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, end_id: bool = False) -> DataFrame:
    """One row per document: length long, its encoded length."""
    path = tokenizer or tokenizer_path()
    extra = int(end_id)
    small_batches(docs.sparkSession)

    def count(batches):
        import pyarrow as pa
        enc = byte_bpe(path)
        for b in batches:
            col = b.column(0)
            for s, e in batches_of(col, 1 << 20):
                ids = enc.encode(col.slice(s, e - s).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([len(x) // 4 + extra for x in ids], pa.int64())], ["length"])

    return docs.select(text_or_empty(text_col).alias("t")).mapInArrow(count, "length long")


def length_histogram(lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """From a column ``length``, one row per length with suffix sums:

    length, n_docs, n_tokens, docs_at_least and tokens_at_least (documents of
    this length or more, and their tokens), truncated_total (tokens left when
    every document is cut to this length), share_up_to (documents of this
    length or less, as a share). The sums go by blocks of lengths, so no task
    sees the whole histogram in detail.
    """
    # Written: the documents are encoded once, not for each of its two readers.
    h = (written(lengths.groupBy("length").agg(F.count("*").alias("n_docs")), "lengths")
         .withColumn("n_tokens", F.col("length") * F.col("n_docs"))
         .withColumn("block", F.floor(F.col("length") / block)))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = (h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
              .select("block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
                      F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                      F.sum("d").over(whole).alias("docs"), F.sum("t").over(whole).alias("tokens")))
    down = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (h.join(blocks, "block")
            .withColumn("docs_at_least", F.sum("n_docs").over(down) + F.col("d_above"))
            .withColumn("tokens_at_least", F.sum("n_tokens").over(down) + F.col("t_above"))
            .select("length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
                    (F.col("tokens") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")).alias("truncated_total"),
                    ((F.col("docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs")).alias("share_up_to")))


def totals(histogram: DataFrame) -> DataFrame:
    """One row: n_docs, n_tokens."""
    return histogram.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
                         F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))


def quantile(histogram: DataFrame, q: float) -> int | None:
    """The least length that at least the share ``q`` of documents do not exceed."""
    return histogram.where(F.col("share_up_to") >= q).agg(F.min("length")).first()[0]


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to ``limit``: from the suffix
    sums of the shortest length of at least ``limit``."""
    at = histogram.where(F.col("length") >= limit).orderBy("length").limit(1).first()
    total = totals(histogram).first()["n_tokens"]
    if at is None:
        return total
    return total - at["tokens_at_least"] + at["docs_at_least"] * limit


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return length_histogram(token_lengths(table(spark, sf_dir, "documents"), end_id=True))
