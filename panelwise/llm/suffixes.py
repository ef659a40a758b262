"""Suffix-array dedup of long repeats by bucket-pointer refinement.

Two positions are in one bucket of depth h if their next h bytes agree; a
bucket's identifier stands for those bytes. Refinement doubles the depth: the
identifier at depth 2h comes from those of a position and of the position h
later, and in the last step, where strings overlap, of the position 72 later
(128 + 128 covers 200). Identifiers are 64-bit hashes of the pair, so every task
refines its own positions, each level reusing the updates of the one before,
and only questions of the kind "is this bucket shared?" travel.

Only positions that may still share a bucket are asked about:

1. Of the q-grams in a ``LENGTH``-byte string the one with the least
   identifier, leftmost, is its anchor (a function of the string alone, so equal
   strings have equal anchors). Successive strings share anchors, one in about
   85 positions. Strings whose anchor's q-gram bucket is not shared are unique.
2. Strings with one anchor form a run. A run whose bytes as a whole occur twice
   is settled: all its strings repeat. The identifiers of runs and of anchors are counted
   over all documents, combined per block of documents before the shuffle.
3. Only strings of unsettled runs, and one copy of a settled run whose anchor
   also has unsettled runs, are asked about one by one.

Buckets are spread over tasks by their identifiers, so a bucket that holds
many positions is one row per block of documents, and no task gathers the
positions themselves.

Every byte covered by a ``LENGTH``-byte string that starts anywhere else as
well, in the same document or another, is removed. Strings compare by their
64-bit identifiers: with n strings asked about, the chance that any two
different ones agree is about n^2 / 2^65.

Defined results: texts are UTF-8 bytes, a null text is empty, texts shorter
than ``LENGTH`` have no repeats; copies of one document remove each other; rows
equal in id and text go to one block; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .blocks import ASKED, arrays, cut_by_part, in_blocks, joined, ordered, row, rows
from .common import fields, ship, small_batches, table

ship(__name__)

LENGTH = 200
Q = 32
BLOCK_BYTES = 4 << 20   # text of a block of documents
# A whole UTF-8 character, kept, or any other byte, dropped.
PARTIAL = (r"([\x00-\x7F]+|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
           r"|\xED[\x80-\x9F][\x80-\xBF]|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})"
           r"|[\x80-\xFF]")
CHUNK = 192 << 10       # bytes refined at a time: its arrays stay in the cache


def combine(a, b):
    """Identifiers of pairs of identifiers (uint64 arrays)."""
    import numpy as np
    u = np.uint64
    x = a * u(0x9E3779B97F4A7C15)
    x ^= b
    x *= u(0xC2B2AE3D27D4EB4F)
    x ^= x >> u(29)
    return x


def refine(raw, length: int, q: int):
    """Identifiers of the q-grams and of the ``length``-byte strings that
    start at each place of ``raw`` (uint8), by doubling."""
    import numpy as np
    u = np.uint64
    x = (raw.astype(u) + u(1)) * u(0x165667B19E3779F9)
    x ^= x >> u(32)
    h, grams = 1, None
    while 2 * h <= length:
        x = combine(x[:-h], x[h:])
        h *= 2
        if h == q:
            grams = x
    return grams, (combine(x[:len(x) - (length - h)], x[length - h:]) if length > h else x)


def find_runs(raw, stops, length: int, q: int):
    """Runs of strings with one anchor in concatenated texts.

    ``stops``: where each text ends. Returns (first, last, anchor_id, run_id,
    strings): first and last start of each run, the q-gram identifier at its anchor,
    the identifier of its bytes, and the identifiers of all strings."""
    import numpy as np
    u = np.uint64
    n = len(raw) - length + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none, none, none.view(u), none.view(u), none.view(u)
    grams, strings = refine(raw, length, q)
    # Least q-gram of each string: the high half of the identifier, then the place.
    key = (grams & ~u(0xFFFFFFFF)) | np.arange(len(grams), dtype=u)
    w = length - q + 1
    padded = np.full(-(-len(key) // w) * w, ~u(0), dtype=u)
    padded[:len(key)] = key
    rows = padded.reshape(-1, w)
    fore = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(back[:n], fore[w - 1:w - 1 + n]) & u(0xFFFFFFFF)).astype(np.int64)
    begins = np.concatenate(([0], stops[:-1]))
    inside = np.zeros(len(raw) + 1, dtype=np.int32)
    ok = stops - begins >= length
    inside[begins[ok]] += 1
    np.subtract.at(inside, stops[ok] - length + 1, 1)
    anchor[np.cumsum(inside)[:n] == 0] = -1
    # Starts of different texts may not share a run, though their anchor cannot
    # agree: a string ends where its text ends.
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    real = anchor[first] >= 0
    first, last = first[real], last[real]
    at = anchor[first]
    shape = ((last - first).astype(u) << u(20)) | (at - first).astype(u)
    run = combine(combine(strings[first], strings[last]), shape)
    return first, last, grams[at], run, strings


def chunks(lengths, length: int, size: int = CHUNK):
    """Cut concatenated texts into (from, to, stops) pieces of about ``size``
    bytes: whole texts, or ranges of starts of a text that is longer."""
    import numpy as np
    stops = np.cumsum(lengths)
    i, at = 0, 0
    while i < len(lengths):
        if lengths[i] > size:
            for s in range(0, int(lengths[i]), size):
                e = min(int(lengths[i]), s + size + length - 1)
                yield at + s, at + e, np.array([e - s])
            at, i = int(stops[i]), i + 1
            continue
        j = max(i + 1, int(np.searchsorted(stops, at + size, side="right")))
        if (long_ := np.flatnonzero(lengths[i:j] > size)).size:
            j = i + int(long_[0])
        yield at, int(stops[j - 1]), stops[i:j] - at
        at, i = int(stops[j - 1]), j


def _loaded(tbl):
    """A block's rows in a fixed order, its bytes and text lengths."""
    import numpy as np
    tbl = ordered(tbl)
    raws = [x.as_buffer() for x in tbl.column("__text")]
    return tbl, np.frombuffer(b"".join(raws), dtype=np.uint8), np.array([x.size for x in raws], dtype=np.int64)


def _spread(start, wide):
    """All places of spans: start, start + 1, ... for each width."""
    import numpy as np
    before = np.cumsum(wide) - wide
    return np.repeat(start - before, wide) + np.arange(int(wide.sum()))


def repeats(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text",
            length: int = LENGTH, q: int = Q, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``columns`` of every document, n_bytes, n_removed, n_spans and kept
    (binary: the bytes that remain)."""
    small_batches(docs.sparkSession)
    held, n, wide = in_blocks(docs, [F.col(c) for c in columns], id_col, text_col, block_bytes)
    parts = max(1, -(-n // 4))  # tasks that count identifiers

    def runs_of(raw, lengths):
        """All runs of a block, with the identifiers of each chunk's strings."""
        import numpy as np
        for s, e, stops in chunks(lengths, length):
            first, last, anchor, run, strings = find_runs(raw[s:e], stops, length, q)
            if len(first):
                yield s, first, last, anchor, run, strings

    def strings_of(raw, start, wide):
        """Identifiers of the strings that start in spans (start, wide)."""
        import numpy as np
        size = wide + length - 1
        upto, ids, s = np.cumsum(size), [], 0
        while s < len(start):
            e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + CHUNK, side="right")))
            _, found = refine(raw[_spread(start[s:e], size[s:e])], length, q)
            ids.append(found[_spread(np.cumsum(size[s:e]) - size[s:e], wide[s:e])])
            s = e
        return np.concatenate(ids)

    def ask_runs(key, tbl):
        """The distinct runs of a block: identifier, anchor, and whether there is one or more."""
        import numpy as np
        tbl, raw, lengths = _loaded(tbl)
        found = [(a, r) for _, _, _, a, r, _ in runs_of(raw, lengths)]
        out = []
        if found:
            run, at, count = np.unique(np.concatenate([r for _, r in found]), return_index=True, return_counts=True)
            anchor = np.concatenate([a for a, _ in found])[at]
            seen = np.minimum(count, 2).astype(np.uint8)
            for p, s, e in cut_by_part(run, parts):
                out.append(row(key[0].as_py(), p, run[s:e], seen[s:e], anchor[s:e]))
        return rows(out)

    def gather(tbl):
        """Rows of a part: blocks, their key counts, and all keys, counts and anchors."""
        import numpy as np
        tbl = tbl.sort_by([("block", "ascending"), ("part", "ascending")])
        keys = arrays(tbl.column("keys"), "u8")
        return (tbl.column("block").to_pylist(), [len(k) for k in keys], np.concatenate(keys),
                joined(tbl.column("seen"), "u1"), joined(tbl.column("more"), "u8"))

    def run_totals(keys, seen, more):
        """Distinct runs of a part: (inverse, settled, anchor)."""
        import numpy as np
        run, at, inv = np.unique(keys, return_index=True, return_inverse=True)
        return inv, np.bincount(inv, seen, minlength=len(run)) >= 2, more[at], at

    def ask_anchors(key, tbl):
        """A part's distinct anchors: one or more places, any unsettled run."""
        import numpy as np
        _, _, keys, seen, more = gather(tbl)
        inv, settled, anchor, _ = run_totals(keys, seen, more)
        a, back = np.unique(anchor, return_inverse=True)
        places = np.minimum(np.bincount(back, np.where(settled, 2, 1), minlength=len(a)), 2).astype(np.uint8)
        open_ = (np.bincount(back, ~settled, minlength=len(a)) > 0).astype(np.uint8)
        return rows([row(key[0].as_py(), p, a[s:e], places[s:e], open_[s:e]) for p, s, e in cut_by_part(a, parts)])

    def tell_anchors(key, tbl):
        """Answers to each asking part: 1 the anchor's bucket is shared, 2 it also has unsettled runs."""
        import numpy as np
        tbl = tbl.sort_by("block")
        keys = arrays(tbl.column("keys"), "u8")
        seen, open_ = joined(tbl.column("seen"), "u1"), joined(tbl.column("more"), "u1")
        a, inv = np.unique(np.concatenate(keys), return_inverse=True)
        shared = np.bincount(inv, seen, minlength=len(a)) >= 2
        code = (shared * (1 + (np.bincount(inv, open_, minlength=len(a)) > 0))).astype(np.uint8)[inv]
        out, s = [], 0
        for to, k in zip(tbl.column("block").to_pylist(), keys):
            out.append(row(to, key[0].as_py(), seen=code[s:s + len(k)]))
            s += len(k)
        return rows(out)

    def tell_runs(key, tbl, answers):
        """Answers to each block, per run: 0 unique, 1 repeats, 2 ask about its
        strings, 3 repeats and its strings are asked about too."""
        import numpy as np
        if not tbl.num_rows:
            return rows([])
        blocks, counts, keys, seen, more = gather(tbl)
        inv, settled, anchor, at = run_totals(keys, seen, more)
        a, back = np.unique(anchor, return_inverse=True)
        told = joined(answers.sort_by("part").column("seen"), "u1")[back]
        code = np.where(settled, 1, np.where(told > 0, 2, 0)).astype(np.uint8)
        each = code[inv]
        each[at[settled & (told == 2)]] = 3  # the first block that has the run
        out, s = [], 0
        for to, c in zip(blocks, counts):
            out.append(row(to, key[0].as_py(), seen=each[s:s + c]))
            s += c
        return rows(out)

    def ask_strings(key, tbl, answers):
        """The distinct strings of a block that are asked about and, in a row
        of the block's own, what puts the answers in place: spans of settled
        runs, and starts and widths of the runs asked about."""
        import numpy as np
        _, raw, lengths = _loaded(tbl)
        if not answers.num_rows:
            return rows([])
        code = joined(answers.sort_by("part").column("seen"), "u1")
        strings = np.empty(len(raw), dtype=np.uint64)
        found = []
        for s, first, last, _, run, ids in runs_of(raw, lengths):
            strings[s:s + len(ids)] = ids
            found.append((first + s, last + s, run))
        first, last, run = (np.concatenate(x) for x in zip(*found))
        _, at, inv = np.unique(run, return_index=True, return_inverse=True)
        each = code[inv]
        second = each == 3
        second[at] = False
        each[second] = 1  # of a settled run its first place here is enough
        ask = each >= 2
        start, wide = first[ask], last[ask] - first[ask] + 1
        ids, count = np.unique(strings[_spread(start, wide)], return_counts=True)
        seen = np.minimum(count, 2).astype(np.uint8)
        block = key[0].as_py()
        out = [row(block, p, ids[s:e], seen[s:e]) for p, s, e in cut_by_part(ids, parts)]
        settled = (each == 1) | (each == 3)
        out.append(row(block, -1 - block, np.stack((first[settled], last[settled])).astype("<i8"),
                       np.stack((start, wide)).astype("<i8")))
        return rows(out)

    def tell_strings(key, tbl):
        """Answers to each block, per string: whether it starts in two places."""
        import numpy as np
        if key[0].as_py() < 0:
            return tbl.select(["block", "part", "keys", "seen", "more"])
        blocks, counts, keys, seen, _ = gather(tbl)
        ids, inv = np.unique(keys, return_inverse=True)
        twice = (np.bincount(inv, seen, minlength=len(ids)) >= 2).astype(np.uint8)[inv]
        out, s = [], 0
        for to, c in zip(blocks, counts):
            out.append(row(to, key[0].as_py(), seen=np.packbits(twice[s:s + c]), more=np.array([c], dtype="<i8")))
            s += c
        return rows(out)

    def cut(key, tbl, answers):
        """The block's documents without their repeats."""
        import numpy as np
        import pyarrow as pa
        tbl, raw, lengths = _loaded(tbl)
        edge = np.zeros(len(raw) + 1, dtype=np.int64)
        twice, place = [], None
        for told_ in answers.sort_by("part").to_pylist():
            if told_["part"] < 0:
                place = told_
            else:
                c = int(np.frombuffer(told_["more"], dtype="<i8")[0])
                twice.append(np.unpackbits(np.frombuffer(told_["seen"], dtype=np.uint8), count=c))
        if place is not None:
            first, last = np.frombuffer(place["keys"], dtype="<i8").reshape(2, -1)
            start, wide = np.frombuffer(place["seen"], dtype="<i8").reshape(2, -1)
            if len(start):
                # Answers are in the order of the sorted strings; refining the
                # asked runs again is cheaper than sending each string's number.
                _, number = np.unique(strings_of(raw, start, wide), return_inverse=True)
                hit = _spread(start, wide)[np.concatenate(twice)[number] == 1]
                first, last = np.concatenate((first, hit)), np.concatenate((last, hit))
            np.add.at(edge, first, 1)
            np.subtract.at(edge, last + length, 1)
        gone = np.cumsum(edge[:-1]) > 0
        stops = np.cumsum(lengths)
        begins = stops - lengths
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        at = begins[lengths > 0]
        rises[at] = gone[at]  # a span ends with its document
        sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], stops))])
        kept = [raw[s:e][~gone[s:e]].tobytes() for s, e in zip(begins.tolist(), stops.tolist())]
        cols = {f"__c{i}": tbl.column(f"__c{i}") for i in range(len(columns))}
        return pa.table({**cols, "n_bytes": pa.array(lengths), "n_removed": pa.array(sums(gone).astype(np.int64)),
                         "n_spans": pa.array(sums(rises).astype(np.int64)), "kept": pa.array(kept, pa.binary())})

    by_block = held.groupBy("block")
    runs = by_block.applyInArrow(ask_runs, ASKED).repartition(max(parts, wide // 4), "part")
    anchors = runs.groupBy("part").applyInArrow(ask_anchors, ASKED).groupBy("part").applyInArrow(tell_anchors, ASKED)
    codes = runs.groupBy("part").cogroup(anchors.groupBy("block")).applyInArrow(tell_runs, ASKED)
    strings = by_block.cogroup(codes.groupBy("block")).applyInArrow(ask_strings, ASKED)
    told = strings.groupBy("part").applyInArrow(tell_strings, ASKED)
    out = by_block.cogroup(told.groupBy("block")).applyInArrow(
        cut, fields(docs, columns, "n_bytes long, n_removed long, n_spans long, kept binary", "__c"))
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], "n_bytes", "n_removed", "n_spans", "kept")


def whole_characters(kept):
    """The text of UTF-8 bytes from which bytes were cut: what is not a whole
    character goes. (Latin-1 gives one character per byte for the pattern.)"""
    return F.decode(F.encode(F.regexp_replace(F.decode(kept, "ISO-8859-1"), PARTIAL, "$1"), "ISO-8859-1"), "UTF-8")


def op3_long_repeats(spark, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
