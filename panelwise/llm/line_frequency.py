"""Quality rules by cross-document line frequency. DataFrame functions only.

Lines are normalised (lower case, white space runs to one space, trimmed) and
hashed. Per host the distinct documents of each line are counted; a line in
more documents than the limit is boilerplate. Boilerplate lines are removed,
and a document that keeps too few of its words is rejected.

Each document is reduced once to its rule
figures and one small row per distinct line (hash and words), written to the
scratch folder. Counting and removal then run on line hashes. Texts are shuffled once: each
text meets the hashes of its own boilerplate lines, by the digest of host and text, so
copies within a host are worked on once. Counts are combined before the shuffle, and the joins of lines with
the boilerplate lines and of texts with theirs are ordinary joins that adaptive execution may split.

A line is boilerplate of a host in more than ``MIN_DOCS`` of its documents. The limit does not
move with the host's size: a line caught today stays caught when the host grows.

Rule figures of a text, with words ``[^\\x20\\x09-\\x0D]+``: n_words, word_chars,
n_symbols, n_dup_lines, n_repeat_words (words in windows of ``WINDOW`` words
found twice or more in the text, the first included). Windows are compared by
64-bit hashes of word hashes.

Defined results: a null text has no words (base_failed, not kept); a null
host is a host of its own; blank lines are no lines; repeated rows count as
documents of their own; an empty table gives an empty result. A cleaned text
has all other lines (blank ones too) as they were; of a null text it is null,
with the digest of an empty text. A column asked for that is named like a result is returned
as ``given_<name>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import SPACES, returned_as, table, text_or_empty, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_DOCS = 10        # a line in at most this many documents of a host stays
MIN_KEPT = 0.5       # a document keeps at least this share of its words

SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
SPLIT = r"'[\\x20\\x09-\\x0D]+'"
WORDS = r"'[^\\x20\\x09-\\x0D]+'"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept",
           "cleaned_text", "cleaned_sha256")
LINE_HASH = f"xxhash64(lower(trim(regexp_replace(l, {SPLIT}, ' '))))"


def rule_figures(docs: DataFrame, columns: list[str], text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``columns``, host, the rule figures and ``lines``: (hash, words) of
    every line of the text that has a word."""
    k = WINDOW
    d = docs.select(*columns, F.col(host_col).alias("__host"), text_or_empty(text_col).alias("__t"))
    d = d.withColumn("__h", F.expr(f"transform(filter(split(__t, {SPLIT}), w -> w != ''), w -> xxhash64(w))"))
    # Windows of k words, by the hash of their word hashes.
    windows = f"transform(sequence(1, size(__h) - {k - 1}), i -> xxhash64(slice(__h, i, {k})))"
    d = d.withColumn("__w", F.expr(f"if(size(__h) >= {k}, {windows}, cast(array() as array<bigint>))"))
    # Most texts repeat no window and stop here. In the others (window, place)
    # pairs are sorted: equal neighbours are repeats, and the sorted places of
    # the repeats give the words they cover.
    pairs = "array_sort(transform(__w, (h, i) -> struct(h as h, i as i)))"
    d = d.withColumn("__p", F.expr(f"if(size(array_distinct(__w)) < size(__w), {pairs}, null)"))
    twice = ("transform(__p, (x, j) -> if((j > 0 and __p[j - 1].h = x.h) or "
             "(j < size(__p) - 1 and __p[j + 1].h = x.h), x.i, -1))")
    d = d.withColumn("__r", F.expr(f"array_sort(filter({twice}, i -> i >= 0))"))
    covered = f"transform(__r, (x, j) -> if(j < size(__r) - 1, least({k}, __r[j + 1] - x), {k}))"
    d = d.withColumn("__l", F.expr(f"filter(split(__t, '\\n'), l -> l rlike {WORDS})"))
    return d.select(
        *columns, F.col("__host").alias("host"), F.expr("cast(size(__h) as bigint)").alias("n_words"),
        F.char_length(F.translate("__t", BLANK, "")).cast("long").alias("word_chars"),
        (F.char_length("__t") - F.char_length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.expr("cast(size(__l) - size(array_distinct(__l)) as bigint)").alias("n_dup_lines"),
        F.expr(f"coalesce(aggregate({covered}, 0L, (a, x) -> a + x), 0L)").alias("n_repeat_words"),
        F.expr(f"transform(__l, l -> struct({LINE_HASH} as hash, regexp_count(l, {WORDS}) as words))").alias("lines"))


def text_key(text_col: str, host_col: str):
    """A 128-bit digest of host and text: rows that agree in it have the same results."""
    host = F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(host).cast("string"), F.lit(":"), host, F.coalesce(F.concat(F.lit("t"), F.col(text_col)), F.lit(""))).cast("binary")))


def line_rules(docs: DataFrame, columns: list[str], text_col: str = "text", host_col: str = "source",
               min_docs: int = MIN_DOCS, min_kept: float = MIN_KEPT, digest_only: bool = False) -> DataFrame:
    """One row per document: ``columns``, the rule figures, n_removed_words
    (words in boilerplate lines), base_failed, kept, cleaned_text (the text
    without its boilerplate lines; left out with ``digest_only``) and cleaned_sha256."""
    own = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    given = docs.select(own.alias("__own"), F.col(text_col).cast("string").alias("__text"), F.col(host_col).alias("__host"))
    given = given.withColumn("__key", text_key("__text", "__host"))
    base = written(rule_figures(given, ["__key"], "__text", "__host").withColumn("__row", F.monotonically_increasing_id()), "line-rules")
    seen = (base.select("host", F.explode(F.array_distinct("lines.hash")).alias("hash"))
            .groupBy("host", "hash").agg(F.count("*").alias("in_docs")))
    common = seen.where(F.col("in_docs") > min_docs).select(F.col("host").alias("h"), F.col("hash").alias("c"))
    lines = base.select("__row", "host", F.inline("lines"))
    removed = (lines.join(common, F.col("host").eqNullSafe(F.col("h")) & (F.col("hash") == F.col("c")), "left_semi")
               .groupBy(F.col("__row").alias("__r")).agg(F.sum("words").alias("removed"), F.collect_set("hash").alias("__gone")))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # Rows of one key agree in everything: any of them stands for all.
    per = (base.select("__key", "__row", *figures).join(removed, F.col("__row") == F.col("__r"), "left")
           .groupBy(F.col("__key").alias("__k")).agg(*[F.max(f).alias(f) for f in figures], F.max("removed").alias("removed"),
                                                     F.first("__gone", ignorenulls=True).alias("__gone")))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    gone = F.coalesce("removed", F.lit(0)).cast("long")
    stays = f"not(l rlike {WORDS}) or not(array_contains(__gone, {LINE_HASH}))"
    cleaned = F.expr(f"if(__gone is null, __text, array_join(filter(split(__text, '\\n'), l -> {stays}), '\n'))")
    out = given.select("__own", "__text", "__key").join(per, F.col("__key") == F.col("__k")).withColumn("__clean", cleaned)
    names = returned_as(columns, RESULTS)
    return out.select(*[F.col("__own")[f"c{i}"].alias(n) for i, n in enumerate(names)], *figures,
                      gone.alias("n_removed_words"), failed.alias("base_failed"),
                      (~failed & (F.col("n_words") - gone >= F.col("n_words") * min_kept)).alias("kept"),
                      *([] if digest_only else [F.col("__clean").alias("cleaned_text")]),
                      F.sha2(F.coalesce("__clean", F.lit("")).cast("binary"), 256).alias("cleaned_sha256"))


def op6_line_frequency(spark, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents"), ["doc_id"], digest_only=True)


# Literal numbers are the parameters above.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, list_slice(ws, i, i + 7) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 8)) AS k) GROUP BY rid),
f AS (SELECT w.rid, doc_id, source, ls, len(ws)::BIGINT AS n_words,
             len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov ON w.rid = cov.rid),
l AS (SELECT rid, source, pos, u, lower(trim(regexp_replace(u, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line,
             len(regexp_extract_all(u, '[^\x20\x09-\x0D]+')) AS words
      FROM (SELECT rid, source, unnest(string_split(t, chr(10))) AS u, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS pos FROM w)),
c AS (SELECT source, line FROM l WHERE words > 0 GROUP BY source, line HAVING count(DISTINCT rid) > 10),
x AS (SELECT l.*, words > 0 AND EXISTS (SELECT 1 FROM c WHERE c.source IS NOT DISTINCT FROM l.source AND c.line = l.line) AS gone FROM l),
r AS (SELECT rid, coalesce(sum(words) FILTER (WHERE gone), 0) AS n, coalesce(string_agg(u, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean
      FROM x GROUP BY rid),
z AS (SELECT f.*, coalesce(r.n, 0)::BIGINT AS n_removed_words, coalesce(r.clean, '') AS clean, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
      FROM f LEFT JOIN r ON f.rid = r.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed,
       NOT base_failed AND n_words - n_removed_words >= n_words * 0.5 AS kept, sha256(clean) AS cleaned_sha256
FROM z
"""
