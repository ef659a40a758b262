"""Byte-level BPE encoding for the token operators.

The vocabulary's splitting pattern never lets a token run across a single
space or line feed that has a character other than white space on both sides
(a space begins the token that follows it, a line feed is its own). A text may
therefore be cut before every such character, and each word encodes alone to
the same ids as inside the text. A text that holds the content of an added
token (``<|endoftext|>``), which the library cuts out first, is encoded whole. Words repeat a lot, so a worker keeps the ids
of the words it has seen lately and hands only new ones to the tokenizers
library: letters to its model, one word after the other, since the pattern leaves them
whole, and all others joined into one text.
"""

from __future__ import annotations

from .common import ship

ship(__name__)

TOKENIZER_FILE = "byte_bpe_50k.json"
MARKS = 5_000          # runs of punctuation after a word that a worker remembers
CACHE_WORDS = 300_000  # words in each of the two generations of the cache


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def worker_state(key, make):
    """An object that a Python worker keeps from task to task."""
    import sys
    import types
    held = sys.modules.setdefault("_panelwise_worker", types.ModuleType("_panelwise_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def words_of(text: str) -> list[str]:
    """Words after single spaces, without the space, and after single line
    feeds, with it."""
    return text.replace("\n", " \n").split(" ")


class WordCache:
    """Ids of words, in two generations: the words of the last ``CACHE_WORDS``
    new ones and of the generation before are remembered."""

    def __init__(self, learn, limit: int = CACHE_WORDS):
        self.learn, self.limit = learn, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, cut: list[list[str]]) -> list[bytes | None]:
        """The joined ids of each list of words; None if ``learn`` leaves
        one of them out."""
        import gc
        gc.disable()  # many short lists and no cycles: collections find nothing
        try:
            return self._encode(cut)
        finally:
            gc.enable()

    def _encode(self, cut: list[list[str]]) -> list[bytes | None]:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = [list(map(young.get, words)) for words in cut]
        gaps, new = [], {}
        for words, ids in zip(cut, found):
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                w = words[at]
                gaps.append((ids, at, w))
                if w not in new:
                    if w in old:
                        young[w] = old[w]
                    else:
                        new[w] = None
        if new:
            young.update(self.learn(list(new)))
        for ids, at, w in gaps:
            ids[at] = young.get(w)
        odd = {id(ids) for ids, at, _ in gaps if ids[at] is None}
        return [None if id(ids) in odd else b"".join(ids) for ids in found]

    def each(self, words: list[str]) -> list[bytes | None]:
        """The ids of each of different words; None where ``learn`` leaves it out."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, words))
        gaps, new = [i for i, ids in enumerate(found) if ids is None], []
        for i in gaps:
            ids = old.get(words[i])
            if ids is None:
                new.append(words[i])
            else:
                young[words[i]] = ids
        if new:
            young.update(self.learn(new))
        for i in gaps:
            found[i] = young.get(words[i])
        return found


class ByteBpe:
    """Ids of whole texts, equal to ``Tokenizer.encode(text,
    add_special_tokens=False)``."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer
        self.np = np
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # The byte length of every id finds the borders of words that were
        # encoded together.
        self.size = np.zeros(self.tok.get_vocab_size(), dtype=np.int64)
        for piece, i in self.tok.get_vocab().items():
            self.size[i] = len(piece)
        self.cache = WordCache(self._learn)
        # Letters up to U+024F with ASCII marks behind them: the pattern cuts
        # such a word before its marks, and the model takes the letters as the vocabulary shows them.
        import re
        from tokenizers.pre_tokenizers import ByteLevel
        direct = self.tok.normalizer is None and isinstance(self.tok.pre_tokenizer, ByteLevel) and self.tok.pre_tokenizer.use_regex
        letter = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
        self.plain = re.compile(rf"(\n?)({letter}+)([!-&(-/:-@\[-`{{-~]*)" if direct else r"(?!)").fullmatch
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {i: shown(chr(i))[0][0] for i in (0x20, *range(0xAA, 0x250))}
        self.raw = [i.to_bytes(4, "little") for i in range(len(self.size))]
        self.line = self._ids(["\n"])[0].tobytes()
        self.marks = {"": b""}

    def _ids(self, texts: list[str]) -> list:
        return [self.np.array(e.ids, dtype="<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of the words that may be cut out of a text: those with no
        white space beside the cuts around them."""
        good = [w for w in new if w and not w[-1].isspace() and not w[w[0] == "\n"].isspace()]
        found, rest = {}, []
        # A few thousand kinds of marks are remembered; words are many.
        plain, marks, known, letters = self.plain, self.marks, self.cache.young, {}
        tokenize, raw, shown, space = self.tok.model.tokenize, self.raw, self.shown, self.shown[0x20]
        if len(marks) > MARKS:
            marks = self.marks = {"": b""}
        for w in good:
            m = plain(w)
            if m is None:
                rest.append(w)
                continue
            line, base, tail = m.groups()
            end = marks.get(tail)
            if end is None:
                end = marks[tail] = self._ids([tail])[0].tobytes()
            start = line + base
            ids = known.get(start) or letters.get(start)
            if ids is None:
                text = base if base.isascii() else base.translate(shown)
                ids = b"".join([raw[x.id] for x in tokenize(text if line else space + text)])
                ids = letters[start] = self.line + ids if line else ids
            found[w] = ids + end
        good = rest
        cut = [w if w[0] == "\n" else " " + w for w in good]
        joint = "".join(cut)
        if not joint:
            return found
        np, ids = self.np, self._ids([joint])[0]
        size = map(len, cut) if joint.isascii() else (len(w.encode()) for w in cut)
        ends = np.cumsum(np.fromiter(size, np.int64, len(cut)))
        at = np.searchsorted(np.cumsum(self.size[ids]), ends) * 4 + 4
        raw, at = ids.tobytes(), at.tolist()
        found.update((w, raw[s:e]) for w, s, e in zip(good, [0, *at], at))
        return found

    def encode(self, texts) -> list[bytes]:
        """Ids of each text (a list or an Arrow array, without nulls) as
        little-endian unsigned 32-bit integers.

        Arrow cuts the texts and numbers the different words, which alone are
        looked up; their ids, taken by those numbers, lie in the order of the words."""
        import pyarrow as pa
        import pyarrow.compute as pc
        np = self.np
        text = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not len(text):
            return []
        special = np.zeros(len(text), dtype=bool)
        for a in self.added:
            special |= pc.match_substring(text, a).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(pa.array(special), "", text), "\n", " \n"), " ")
        at = cut.offsets.to_numpy().astype(np.int64)
        words = cut.flatten().dictionary_encode()
        ids = self.cache.each(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        joined = pa.array(ids, pa.large_binary()).take(words.indices)
        missing = joined.is_null().to_numpy(zero_copy_only=False).copy()
        missing[at[:-1]] = False
        missing = np.concatenate([[0], np.cumsum(missing)])
        ends = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset:joined.offset + len(joined) + 1]
        data = memoryview(joined.buffers()[2] or b"")
        # The first word has no space before it, and texts with unsafe cuts
        # are encoded whole.
        heads = words.take(pa.array(at[:-1])).cast(pa.large_string()).to_pylist()
        unsafe = special | (missing[at[1:]] > missing[at[:-1] + 1])
        whole = [i for i, (h, u) in enumerate(zip(heads, unsafe.tolist())) if u or not h or h[-1].isspace()]
        odd = set(whole)
        first = [i for i in range(len(text)) if i not in odd]
        start, stop = ends[at[:-1] + 1].tolist(), ends[at[1:]].tolist()
        out = [b""] * len(text)
        for i, e in zip(whole + first, self._ids([text[i].as_py() for i in whole] + [heads[i] for i in first])):
            out[i] = e.tobytes() + (b"" if i in odd else data[start[i]:stop[i]])
        return out


def byte_bpe(path: str) -> ByteBpe:
    return worker_state(("byte_bpe", path), lambda: ByteBpe(path))
