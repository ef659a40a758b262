import numpy as np
import pytest
import sentencepiece as sp

from panelwise.llm import pieces

from .conftest import make_docs, some_texts

ODD = ["", " ", "  a", "a  b", "a \n b", "end ", "\n", "\nx", "a\n\nb  c", "<s> hi", " lead", "tab\t tab", "日本 語 テ",
       "a\x1c b", "é x", "a▁b", "▁", "😀 x", "\r\n x", "﻿x y"]


@pytest.fixture(scope="module")
def library():
    return sp.SentencePieceProcessor(model_file=pieces.model_path())


def test_ids_and_spans_equal_the_library(library):
    coder = pieces.Pieces(pieces.model_path())
    assert coder.cache is not None
    texts = ODD + [t or "" for t in some_texts()]
    for _ in range(2):  # the second time from the cache
        made = coder.encode(texts)
        assert [np.frombuffer(i, "<u4").tolist() for i, _ in made] == library.encode(texts, add_bos=True, add_eos=True)
    for t, (_, ends) in zip(texts, made):
        want = [p.end for p in library.encode(t, return_type="proto").pieces]
        assert np.frombuffer(ends, "<u4").tolist() == [0, *want, len(t.encode())]
    assert coder.decode([i for i, _ in made]) == [library.decode(x) for x in library.encode(texts, add_bos=True, add_eos=True)]


def test_text_by_text_path(library):
    coder = pieces.Pieces(pieces.model_path())
    by_words = coder.encode(ODD)
    coder.cache = None
    assert coder.encode(ODD) == by_words


def compiled(entries):
    """A character map with the given prefixes, as a double array built here
    by the published layout: offset in bits 10 up, leaf flag 8, label 0-7."""
    import struct
    tree, texts, at = {}, b"", {}
    for k, v in entries.items():
        at[k] = len(texts)
        texts += v + b"\0"
        node = tree
        for b in k:
            node = node.setdefault(b, {})
        node[None] = at[k]
    units, used, bases = {0: 0}, {0}, set()

    def place(node, index, label):
        kids = [c for c in node if c is not None]
        want = kids + ([0] if None in node else [])
        base = 1
        while base in bases or any((base ^ c) in used or base ^ c == index for c in want) or base ^ index >= 1 << 21:
            base += 1
        bases.add(base)  # no two nodes share one
        used.update(base ^ c for c in want)
        units[index] = ((base ^ index) << 10) | ((1 << 8) if None in node else 0) | label
        if None in node:
            units[base ^ 0] = (1 << 31) | node[None]
        for c in kids:
            place(node[c], base ^ c, c)

    place(tree, 0, 0)
    array = [units.get(i, 0) for i in range(max(units) + 1)]
    return struct.pack("<I", 4 * len(array)) + struct.pack(f"<{len(array)}I", *array) + texts


class Spec:
    def __init__(self, charsmap, prefix=True, trim=True, escape=True):
        self.precompiled_charsmap, self.add_dummy_prefix = charsmap, prefix
        self.remove_extra_whitespaces, self.escape_whitespaces = trim, escape


MAP = {"ﬁ".encode(): b"fi", "Ａ".encode(): b"A", "ab".encode(): b"X", "abc".encode(): b"YZ", "\t".encode(): b" ", "é".encode(): "é".encode(), "​".encode(): b""}


def test_longest_prefix_and_alignment():
    n = pieces.Normaliser(Spec(compiled(MAP)))
    assert n.map.longest(b"abcd", 0) == (3, b"YZ") and n.map.longest(b"abd", 0) == (2, b"X") and n.map.longest(b"ad", 0) is None
    text = "  abcabdﬁ\t ​Ａ é  "
    norm, origin = n(text.encode())
    assert norm.decode() == "▁YZXdfi▁A▁é"
    assert len(origin) == len(norm) + 1 and origin == sorted(origin)
    raw = text.encode()
    assert origin[norm.index(b"YZ")] == raw.index(b"abc") and origin[norm.index(b"fi")] == raw.index("ﬁ".encode()) == origin[norm.index(b"fi") + 1]
    assert origin[-1] == len(text.rstrip(" ").encode())
    assert n(b"   ") == (b"", [3]) and n(b"") == (b"", [0])


def test_plain_normaliser_keeps_spaces():
    n = pieces.Normaliser(Spec(b"", trim=False))
    assert n.plain and n(b"a  b")[0].decode() == "▁a▁▁b"
    assert n(b"a b")[1] == [0, 0, 0, 0, 1, 1, 1, 2, 3]


def test_query_form(spark, no_docs):
    docs = make_docs(spark, some_texts() + ODD)
    e = pieces.encoded(docs, ["doc_id", "fp", "lang"])
    rows = e.collect()
    assert e.columns == ["doc_id", "fp", "lang", "ids", "ends", "decoded"] and len(rows) == docs.count()
    texts = dict(enumerate(some_texts() + ODD))
    for r in rows:
        assert r["decoded"] == (texts[r["doc_id"]] or "").replace("▁", " ")
    assert pieces.encoded(no_docs, ["doc_id"]).count() == 0


def test_clashing_names_and_very_long_texts(spark):
    import sentencepiece
    from panelwise.llm import pieces
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = ["Ärger  of 日本 " * 40_000, "no_spaces" * 20_000, "b c"]
    docs = spark.createDataFrame([(i, t, b"own", "end", 5) for i, t in enumerate(texts)], "doc_id long, text string, ids binary, ends string, decoded int")
    rows = {r["doc_id"]: r for r in pieces.encoded(docs, ["doc_id", "ids", "ends", "decoded"]).collect()}
    for i, t in enumerate(texts):
        want = [sp.bos_id(), *sp.encode(t), sp.eos_id()]
        assert np.frombuffer(rows[i]["ids"], "<u4").tolist() == want and rows[i]["decoded"] == sp.decode(want)
        assert np.frombuffer(rows[i]["ends"], "<u4")[-1] == len(t.encode())
        assert (bytes(rows[i]["given_ids"]), rows[i]["given_ends"], rows[i]["given_decoded"]) == (b"own", "end", 5)
