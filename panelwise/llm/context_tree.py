"""LM scoring by context-tree weighting over bytes.

A byte is eight binary decisions; the context of a decision is the bytes before
it (up to ``DEPTH``) and the byte's bits so far. Every context of every depth
has a Krichevsky-Trofimov estimator over its counts in the training texts, and
a weighted probability: half its own estimate, half the product of its
children's (contexts one byte longer). For a new bit this mixes the estimates of
all depths with weights that the training texts give, and the eight mixed
bits give the byte's probability, so each byte has a code length.

The tree is built once from the distinct (context, byte) grams of the corpus
and their training counts; texts never meet it whole. A block of documents
sends its distinct grams, tasks that own a share of all grams add up the
counts, tasks that own a share of the contexts (by the two latest bytes) build the
tree below depth 2 and sum up what depths 1 and 0 need (at most 3 * 65,536
numbers), and the log probability of each gram goes back the same way to the
blocks that asked. The size of a task's share follows the distinct grams, and
a gram that every document has is one entry per block. Messages hold sorted grams as
packed differences (2 to 3 bytes a gram) and log probabilities to 36 bits of
their fractions, so a score's relative error is 2^-37 (about 7e-12) at most.

The word base (c + 1) / (N + V + 1) asks for word counts in the same way, by
64-bit hashes of words.

A text is its UTF-8 bytes with A-Z in lower case, between begin marks (context only) and an
end mark, which is scored like a byte. Training texts are the documents for
which ``held_out`` is false.

Defined results: a null or empty text scores its end mark; a null id counts as
the empty string in ``held_out``; without training texts every bit has
probability 1/2 and N = V = 0; rows equal in id and text go to one block; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .blocks import ASKED, arrays, cut_by_part, in_blocks, joined, ordered, packed, packed_keys, row, rows, unpacked, unpacked_keys
from .common import fields, returned_as, ship, small_batches, table

ship(__name__)

DEPTH = 6
BLOCK_BYTES = 8 << 20
CHUNK = 1 << 20      # places sorted at a time
MARK = 0xFF          # no UTF-8 text has this byte
MAX_MODELS = 4096    # each gets the 1 MB of depths 1 and 0; there are 65,536 two-byte contexts at most
SCATTER = 0x9E3779B97F4A7C15
FOLDS, HELD_OUT = 7, 2
SCALE = 1 << 30      # sums of log weights travel as whole numbers and such fractions: exact in any order
RESULTS = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
SUMS = 196_610       # counts, whole log weights, N and V, fractions of log weights


def log_gamma(x):
    """ln gamma(x) for x >= 1/2, by Stirling's series after shifting up to 8."""
    import numpy as np
    x = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    tail = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + tail - shift


def log_kt(zeros, ones):
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    import numpy as np
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def mixed(own, below):
    """ln of half exp(own) + half exp(below), and the share of ``own`` in it."""
    import numpy as np
    both = np.logaddexp(own, below)
    return both - np.log(2), np.exp(own - both)


def gram_keys(seq):
    """For every place of a byte sequence from DEPTH on: the context, latest
    byte first, then the byte itself, as one number of 8 * (DEPTH + 1) bits."""
    import numpy as np
    u = np.uint64
    x = seq.astype(u)
    n = len(x) - DEPTH
    key = np.zeros(n, dtype=u)
    for d in range(1, DEPTH + 1):
        key = (key << u(8)) | x[DEPTH - d:DEPTH - d + n]
    return (key << u(8)) | x[DEPTH:]


def runs(x):
    """Starts of the runs of equal neighbours."""
    import numpy as np
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, dtype=np.int64)


def rounded(x):
    """Doubles as whole numbers of 48 bits: 36 bits of their fractions, a
    relative error of 2^-37 at most."""
    import numpy as np
    u = np.uint64
    return (np.asarray(x, dtype="<f8").view(np.uint64) + u(1 << 15)) >> u(16)


def as_doubles(x):
    import numpy as np
    return (x << np.uint64(16)).view("<f8")


class Level:
    """All decisions with contexts of one depth: per bit the nodes, their
    estimates and weights."""

    def __init__(self, keys, counts):
        """``keys``: sorted (context, byte) numbers, ``counts`` their counts."""
        import numpy as np
        u = np.uint64
        self.keys, self.nodes, self.at, self.kt, self.one = keys, [], [], [], []
        context, byte = keys >> u(8), keys & u(255)
        for k in range(8):
            node = (context << u(k)) | (byte >> u(8 - k))
            first = runs(node)
            bit = ((byte >> u(7 - k)) & u(1)).astype(np.int64)
            total = np.add.reduceat(counts, first) if len(first) else counts[:0]
            ones = np.add.reduceat(counts * bit, first) if len(first) else counts[:0]
            at = np.zeros(len(keys), dtype=np.int64)
            at[first[1:]] = 1
            self.nodes.append(node[first])
            self.at.append(np.cumsum(at))
            self.kt.append(log_kt((total - ones).astype(float), ones.astype(float)))
            self.one.append((ones + 0.5) / (total + 1.0))

    def parents(self, k):
        """The nodes one byte shorter: the earliest byte of the context goes."""
        import numpy as np
        u = np.uint64
        low = self.nodes[k] & u((1 << k) - 1)
        return ((self.nodes[k] >> u(k + 8)) << u(k)) | low


def tree(grams, counts):
    """Levels DEPTH .. 2 of the grams of some whole two-byte contexts, their
    log weights and the share of each node's own estimate."""
    import numpy as np
    u = np.uint64
    levels, weights, shares = {}, {}, {}
    for d in range(DEPTH, 1, -1):
        if d == DEPTH:
            keys, n = grams, counts
        else:  # contexts are latest byte first, so shorter ones stay sorted within equal bytes
            short = ((grams >> u(8 * (DEPTH - d + 1))) << u(8)) | (grams & u(255))
            keys, back = np.unique(short, return_inverse=True)
            n = np.bincount(back, counts, minlength=len(keys)).astype(np.int64)
        levels[d] = Level(keys, n)
    for d in range(DEPTH, 1, -1):
        lv = levels[d]
        if d == DEPTH:
            weights[d], shares[d] = lv.kt, [np.ones(len(x)) for x in lv.kt]
            continue
        weights[d], shares[d] = [], []
        for k in range(8):
            child = levels[d + 1]
            at = np.searchsorted(lv.nodes[k], child.parents(k))
            below = np.bincount(at, weights[d + 1][k], minlength=len(lv.nodes[k]))
            w, s = mixed(lv.kt[k], below)
            weights[d].append(w)
            shares[d].append(s)
    return levels, weights, shares


class Top:
    """Depths 1 and 0 as tables over (latest byte, bits so far)."""

    def __init__(self, counts, below):
        """counts[c, byte] and, per (c, node), the sum of the log weights at
        depth 2; a node is 1 followed by the bits so far."""
        import numpy as np
        node = np.arange(256)
        ones, zeros = np.zeros((256, 256)), np.zeros((256, 256))
        for k in range(8):
            for byte in range(256):
                at = (1 << k) | (byte >> (8 - k))
                (ones if byte >> (7 - k) & 1 else zeros)[:, at] += counts[:, byte]
        real = node >= 1
        self.one1 = (ones + 0.5) / (ones + zeros + 1)
        w1, self.share1 = mixed(log_kt(zeros, ones), below)
        w1[:, ~real] = 0
        a, b = zeros.sum(axis=0), ones.sum(axis=0)
        self.one0 = (b + 0.5) / (a + b + 1)
        _, self.share0 = mixed(log_kt(a, b), w1.sum(axis=0))


def gram_log10(grams, counts, top: Top):
    """log10 probability of each gram's byte after its context."""
    import numpy as np
    u = np.uint64
    levels, _, shares = tree(grams, counts)
    up = {d: np.searchsorted(levels[d].keys, ((grams >> u(8 * (DEPTH - d + 1))) << u(8)) | (grams & u(255)))
          for d in range(2, DEPTH)}
    up[DEPTH] = np.arange(len(grams))
    byte = (grams & u(255)).astype(np.int64)
    latest = (grams >> u(8 * DEPTH)).astype(np.int64)
    out = np.zeros(len(grams))
    for k in range(8):
        p = None
        for d in range(DEPTH, 1, -1):
            at = levels[d].at[k][up[d]]
            one, share = levels[d].one[k][at], shares[d][k][at]
            p = one if p is None else share * one + (1 - share) * p
        node = (1 << k) | (byte >> (8 - k))
        p = top.share1[latest, node] * top.one1[latest, node] + (1 - top.share1[latest, node]) * p
        p = top.share0[node] * top.one0[node] + (1 - top.share0[node]) * p
        bit = byte >> (7 - k) & 1
        out += np.log10(np.where(bit == 1, p, 1 - p))
    return out


def held_out(id_col: str, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def scores(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``columns`` of every document, held_out, n_tokens, n_known,
    train_tokens, base_score, score (log10 probability of the text), n_bytes
    (with the end mark) and bits_per_byte (code length per byte). A column
    named like one of these is returned as ``given_<name>``."""
    small_batches(docs.sparkSession)
    held, n, wide = in_blocks(docs, [held_out(id_col), *[F.col(c) for c in columns]], id_col, text_col, block_bytes)
    n_columns = len(columns)
    parts = max(1, -(-n // 2))      # tasks that add up counts
    models = max(1, min(-(-n // 4), MAX_MODELS))  # tasks that own contexts
    WORDS = parts                   # parts from here on hold words

    def load(tbl):
        tbl = ordered(tbl)
        return tbl, [x.as_py().lower() for x in tbl.column("__text")], tbl.column("__c0").to_pylist()

    def places(texts):
        """Chunks of texts: (from, to, sequence, first key and scored places of each text)."""
        import numpy as np
        s = 0
        while s < len(texts):
            e, size = s, 0
            while e < len(texts) and (e == s or size + len(texts[e]) <= CHUNK):
                size += len(texts[e]) + DEPTH + 1
                e += 1
            begin, end = bytes([MARK]) * DEPTH, bytes([MARK])
            seq = np.frombuffer(b"".join(x for t in texts[s:e] for x in (begin, t, end)), dtype=np.uint8)
            size = np.array([len(t) + 1 for t in texts[s:e]], dtype=np.int64)
            first = np.cumsum(size + DEPTH) - size - DEPTH  # of each text, among the keys
            yield s, e, seq, first, size
            s = e

    def spread(first, size):
        import numpy as np
        before = np.cumsum(size) - size
        return np.repeat(first - before, size) + np.arange(int(size.sum()))

    def hashes(words):
        import numpy as np
        from xxhash import xxh64_intdigest
        return np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)

    def block_grams(texts, out):
        """Distinct grams of a block, sorted, and their counts in training texts."""
        import numpy as np
        u = np.uint64
        found = []
        for s, e, seq, first, size in places(texts):
            train = np.repeat(np.array([not o for o in out[s:e]], dtype=u), size)
            x = np.sort((gram_keys(seq)[spread(first, size)] << u(1)) | train)
            at = runs(x >> u(1))
            found.append((x[at] >> u(1), np.add.reduceat((x & u(1)).astype(np.int64), at)))
        keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        return keys, np.bincount(back, np.concatenate([c for _, c in found]), minlength=len(keys)).astype(np.int64)

    def block_words(texts, out):
        """Distinct words of a block by hash, sorted: (hashes, words, counts in training texts)."""
        from collections import Counter
        import numpy as np
        count, other = Counter(), set()
        for t, o in zip(texts, out):
            if o:
                other.update(t.split())
            else:
                count.update(t.split())
        for w in other:
            count.setdefault(w, 0)
        # The end token, at its own key: one per training text.
        words = [*count, b" "]
        counts = np.array([*count.values(), sum(not o for o in out)], dtype=np.int64)
        keys = hashes(words)
        order = np.argsort(keys)
        return keys[order], [words[i] for i in order.tolist()], counts[order]

    def by_part(grams):
        """The order of sorted grams by part, and (part, from, to) in it. A
        part has whole contexts of the four latest bytes, by their hash, and its grams stay sorted:
        neighbours differ little, so a message needs 2 to 3 bytes a gram."""
        import numpy as np
        u = np.uint64
        with np.errstate(over="ignore"):
            part = ((((grams >> u(8 * (DEPTH - 3))) * u(SCATTER) >> u(32)) * u(parts)) >> u(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        first = runs(part[order])
        return order, [(int(part[order[s]]), int(s), int(e)) for s, e in zip(first, [*first[1:], len(order)])]

    def ask(key, tbl):
        _, texts, out = load(tbl)
        if not texts:
            return rows([])
        block = key[0].as_py()
        grams, counts = block_grams(texts, out)
        order, cuts = by_part(grams)
        made = [row(block, p, packed_keys(grams[order[s:e]]), packed(counts[order[s:e]].astype("<u4"))) for p, s, e in cuts]
        keys, _, counts = block_words(texts, out)
        counts = counts.astype("<u4")
        return rows(made + [row(block, WORDS + p, packed_keys(keys[s:e]), packed(counts[s:e])) for p, s, e in cut_by_part(keys, parts)])

    def totals(tbl):
        """A part's distinct keys with their total counts, and where each asked key is."""
        import numpy as np
        tbl = tbl.sort_by("block")
        asked = [unpacked_keys(x.as_py()) for x in tbl.column("keys")]
        keys, back = np.unique(np.concatenate(asked), return_inverse=True)
        seen = np.concatenate([unpacked(x.as_py(), "<u4") for x in tbl.column("seen")])
        count = np.bincount(back, seen, minlength=len(keys)).astype(np.int64)
        return tbl.column("block").to_pylist(), [len(x) for x in asked], keys, back, count

    def owners(grams):
        """The model task of each gram: by its two latest context bytes."""
        import numpy as np
        u = np.uint64
        two = grams >> u(8 * (DEPTH - 1))
        with np.errstate(over="ignore"):
            return ((((two * u(SCATTER)) >> u(32)) * u(models)) >> u(32)).astype(np.int64)

    def share_out(key, tbl):
        """Distinct grams of a part to the tasks that own their contexts; of a
        part of words, its tokens and distinct words in training texts."""
        import numpy as np
        part = key[0].as_py()
        _, _, keys, _, count = totals(tbl)
        if part >= WORDS:
            return rows([row(part, part % models, seen=np.array([count.sum(), (count > 0).sum()], dtype="<i8"))])
        owner = owners(keys)
        order = np.argsort(owner, kind="stable")
        out = []
        for s, e in zip(at := runs(owner[order]).tolist(), [*at[1:], len(order)]):
            mine = order[s:e]
            out.append(row(part, int(owner[mine[0]]), packed_keys(keys[mine]), packed(count[mine].astype("<i8"))))
        return rows(out)

    def own(tbl):
        """An owner's grams, sorted, their counts, and the asking rows."""
        import numpy as np
        tbl = tbl.sort_by("block")
        asked = [unpacked_keys(x.as_py()) for x in tbl.column("keys")]
        grams = np.concatenate(asked)
        counts = np.concatenate([unpacked(c.as_py(), "<i8") for c, k in zip(tbl.column("seen"), asked) if len(k)] or [np.zeros(0, dtype=np.int64)])
        order = np.argsort(grams)
        return tbl.column("block").to_pylist(), asked, grams, order, counts

    def below_top(key, tbl):
        """What depths 1 and 0 need of an owner's contexts: (place, value)."""
        import numpy as np
        import pyarrow as pa
        u = np.uint64
        _, _, grams, order, counts = own(tbl)
        grams, counts = grams[order], counts[order]
        place, value = [], []
        if len(grams):
            pair = ((grams >> u(8 * DEPTH)) << u(8)) | (grams & u(255))
            at, back = np.unique(pair, return_inverse=True)
            place.append(at.astype(np.int64))
            value.append(np.bincount(back, counts, minlength=len(at)).astype(np.int64))
            levels, weights, _ = tree(grams, counts)
            for k in range(8):
                up = levels[2].parents(k)
                c, bits = (up >> u(k)).astype(np.int64), (up & u((1 << k) - 1)).astype(np.int64)
                at, back = np.unique(65536 + c * 256 + ((1 << k) | bits), return_inverse=True)
                whole = np.floor(weights[2][k])
                for first, part in ((0, whole), (65538, np.round((weights[2][k] - whole) * SCALE))):
                    place.append(at + first)
                    value.append(np.round(np.bincount(back, part, minlength=len(at))).astype(np.int64))
        words = [np.frombuffer(x.as_py(), dtype="<i8") for x, k in zip(tbl.column("seen"), tbl.column("keys")) if not k.is_valid]
        if words:
            place.append(np.array([131072, 131073]))
            value.append(np.sum(words, axis=0))
        return pa.table({"place": pa.array(np.concatenate(place or [np.zeros(0, np.int64)])), "value": pa.array(np.concatenate(value or [np.zeros(0, np.int64)]))})

    def one_row(key, tbl):
        """At most ``SUMS`` sums as one row."""
        import numpy as np
        all_ = np.zeros(SUMS, dtype="<i8")
        all_[tbl.column("place").to_numpy()] = tbl.column("value").to_numpy()
        return rows([row(0, 0, all_)])

    def evaluate(key, tbl, top):
        """The log10 probability of every gram of an owner, to the parts that asked."""
        import numpy as np
        if not tbl.num_rows:
            return rows([])
        sums = joined(top.column("keys"), "<i8")
        blocks, asked, grams, order, counts = own(tbl)
        counts_top = sums[:65536].reshape(256, 256).astype(float)
        below = (sums[65536:131072] + sums[131074:] / SCALE).reshape(256, 256)
        out = np.zeros(len(grams), dtype="<f8")
        if len(grams):
            out[order] = gram_log10(grams[order], counts[order], Top(counts_top, below))
        made, s = [], 0
        for to, k in zip(blocks, asked):
            made.append(row(to, key[0].as_py(), out[s:s + len(k)], sums[131072:131074]))
            s += len(k)
        return rows(made)

    def tell(key, tbl, answers):
        """Answers to the blocks: log10 probabilities, or total counts with N and V."""
        import numpy as np
        part = key[0].as_py()
        if not tbl.num_rows:
            return rows([])
        blocks, asked, keys, back, count = totals(tbl)
        scalars = None
        if part >= WORDS:
            value = count.astype("<i8")
            scalars = arrays(answers.column("seen"), "<i8")[0]
        else:
            value = np.zeros(len(keys), dtype="<f8")
            order = np.argsort(owners(keys), kind="stable")
            value[order] = joined(answers.sort_by("part").column("keys"), "<f8")
            value = rounded(value)
        value, made, s = value[back], [], 0
        for to, k in zip(blocks, asked):
            made.append(row(to, part, packed(value[s:s + k]), scalars))
            s += k
        return rows(made)

    def finish(key, tbl, answers):
        """The scores of a block's documents."""
        import numpy as np
        import pyarrow as pa
        u = np.uint64
        tbl, texts, out = load(tbl)
        answers = answers.sort_by("part")
        part = answers.column("part").to_numpy()
        of_grams, of_words = answers.filter(pa.array(part < WORDS)), answers.filter(pa.array(part >= WORDS))
        total, distinct = (int(x) for x in arrays(of_words.column("seen"), "<i8")[0])
        sorted_places, found = [], []
        for s, e, seq, first, size in places(texts):
            keys = gram_keys(seq)[spread(first, size)]
            place = np.argsort(keys)  # equal grams have one value: any order of them will do
            here = keys[place]
            at = runs(here)
            found.append(here[at])
            sorted_places.append((place.astype(np.int32), np.diff(np.concatenate((at, [len(here)]))).astype(np.int32), size))
        grams = np.unique(np.concatenate(found))
        order, _ = by_part(grams)
        value = np.zeros(len(grams), dtype=np.float64)
        value[order] = as_doubles(np.concatenate([unpacked(x.as_py(), "<u8") for x in of_grams.column("keys")]))
        score = []
        for own, (place, often, size) in zip(found, sorted_places):
            each = np.empty(len(place))
            each[place] = np.repeat(value[np.searchsorted(grams, own)], often)
            score.append(np.add.reduceat(each, np.cumsum(size) - size))
        _, words, _ = block_words(texts, out)
        count = np.concatenate([unpacked(x.as_py(), "<i8") for x in of_words.column("keys")])
        logs = dict(zip(words, np.log10(count + 1.0).tolist()))
        known = {w for w, c in zip(words, count.tolist()) if c > 0}
        end = logs.pop(b" ")
        n_tokens, n_known, base = [], [], []
        for t in texts:
            ws = t.split()
            n_tokens.append(len(ws) + 1)
            n_known.append(sum(map(known.__contains__, ws)) + (b" " in known))
            base.append(sum(map(logs.__getitem__, ws)) + end)
        n_tokens = np.array(n_tokens, dtype=np.int64)
        score = np.concatenate(score)
        n_bytes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        return pa.table({
            **{f"__c{i}": tbl.column(f"__c{i}") for i in range(n_columns + 1)},
            "n_tokens": pa.array(n_tokens), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array(np.full(len(texts), total), pa.int64()),
            "base_score": pa.array(np.array(base) - n_tokens * np.log10(total + distinct + 1.0)),
            "score": pa.array(score), "n_bytes": pa.array(n_bytes),
            "bits_per_byte": pa.array(-score * np.log2(10) / n_bytes)})

    by_block = held.groupBy("block")
    asked = by_block.applyInArrow(ask, ASKED).repartition(max(parts, wide), "part")
    owned = asked.groupBy("part").applyInArrow(share_out, ASKED).repartition(max(models, wide // 2), "part")
    sums = (owned.groupBy("part").applyInArrow(below_top, "place long, value long").groupBy("place").agg(F.sum("value").alias("value"))
            .groupBy(F.lit(0).alias("all")).applyInArrow(one_row, ASKED))
    top = sums.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(models - 1).cast("long"))).alias("part"), "keys", "seen", "more")
    told = owned.groupBy("part").cogroup(top.groupBy("part")).applyInArrow(evaluate, ASKED)
    answers = asked.groupBy("part").cogroup(told.groupBy("block")).applyInArrow(tell, ASKED)
    scored = "n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    given = docs.select(held_out(id_col).alias("__c0"), *[F.col(c).alias(f"__c{i + 1}") for i, c in enumerate(columns)])
    result = by_block.cogroup(answers.groupBy("block")).applyInArrow(finish, fields(given, given.columns, scored))
    names = returned_as(columns, RESULTS)
    return result.select(*[F.col(f"__c{i + 1}").alias(n) for i, n in enumerate(names)], F.col("__c0").alias("held_out"), *RESULTS[1:])


def op1_context_tree(spark, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), ["doc_id"])
