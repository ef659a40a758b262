"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation walks a text by longest prefixes through the model's compiled
character map and records, for every byte of the normalised text, the place in
the original that it came from. The library splits the normalised text into pieces; their
lengths give borders in it, and the recorded alignment projects every border to
an original byte. Pieces cover the normalised text without gaps, so a piece
begins where the one before it ends.

For a BPE model without a character map whose pieces never run across a space
or line feed (checked on its vocabulary), words after them encode alone; a
worker then keeps the ids of words it has seen lately. Other models are encoded text by text.

Defined results: a null or empty text has only its begin and end ids and
decodes to an empty text; an empty table gives an empty result; extra columns
are kept as given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import asked_for, batches_of, fields, ship, small_batches, table, text_or_empty
from .tokens import WordCache, worker_state, words_of

ship(__name__)

MODEL_FILE = "piece_bpe_32k.model"
SPACE = "▁"
RESULTS = ("ids", "ends", "decoded")


def model_path(name: str = MODEL_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class CharacterMap:
    """A compiled character map: a double-array trie of prefixes, then their
    replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        import struct
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size:]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest prefix of ``raw[at:]``."""
        units, best = self.units, None
        if not units:
            return None
        jump = lambda unit: (unit >> 10) << ((unit >> 6) & 8)  # noqa: E731  the step to a unit's children
        node = jump(units[0])
        for k in range(at, len(raw)):
            node ^= raw[k]
            if node >= len(units) or units[node] & 0x800000FF != raw[k]:
                break
            unit = units[node]
            node ^= jump(unit)
            if unit & 0x100:  # a prefix ends here; its value is the first child
                best = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        length, value = best
        return length, self.texts[value:self.texts.index(b"\0", value)]


class Normaliser:
    """The normalised bytes of a text and, for each of them and the end, the
    original byte they came from."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.space = SPACE.encode() if self.escape else b" "
        self.plain = not self.map.units and not self.trim and self.escape

    def __call__(self, raw: bytes):
        out, origin = bytearray(), []
        if not raw:
            return b"", [0]
        steps, at = [], 0
        while at < len(raw):
            hit = self.map.longest(raw, at)
            if hit is None:
                n = 1
                while at + n < len(raw) and raw[at + n] & 0xC0 == 0x80:
                    n += 1
                hit = (n, raw[at:at + n])
            steps.append((at, *hit))
            at += hit[0]
        if self.trim:
            while steps and steps[0][2] == b" ":
                steps.pop(0)
        if not steps:
            return b"", [len(raw)]
        if self.prefix:
            out += self.space
            origin += [steps[0][0]] * len(self.space)
        after_space = self.trim
        for start, _, text in steps:
            if self.trim and after_space:
                text = text.lstrip(b" ")
            if not text:
                continue
            after_space = text.endswith(b" ")
            new = text.replace(b" ", self.space)
            out += new
            origin += [start] * len(new)
        end = len(raw)
        if self.trim:
            while out.endswith(self.space):
                end = origin[len(out) - len(self.space)]
                del out[-len(self.space):]
                del origin[-len(self.space):]
        return bytes(out), origin + [end]


class Pieces:
    def __init__(self, path: str):
        import numpy as np
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.np = np
        self.sp = sp.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self.sp.serialized_model_proto())
        self.normal = Normaliser(model.normalizer_spec)
        kinds = pb.ModelProto.SentencePiece
        self.bytes = {p.piece for p in model.pieces if p.type == kinds.BYTE}
        self.control = {i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        # Bytes of the normalised text that a piece covers.
        self.size = np.array([1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.encode())
                              for p in model.pieces], dtype=np.int64)
        crosses = any("\n" in p.piece or SPACE in p.piece.lstrip(SPACE) for p in model.pieces if p.type not in (kinds.BYTE, kinds.CONTROL))
        own = any(p.type == kinds.USER_DEFINED for p in model.pieces)
        t, n = model.trainer_spec, model.normalizer_spec
        by_words = (t.model_type == t.BPE and t.byte_fallback and not t.treat_whitespace_as_suffix
                    and self.normal.plain and n.add_dummy_prefix and not crosses and not own)
        self.space_id = self.sp.piece_to_id(SPACE)
        self.cache = WordCache(self._learn) if by_words else None

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of words. The library puts a space before a text, which is the
        one before the word; after a line feed there is none, and it goes."""
        np = self.np
        good = [w for w in new if w and w[0] != " " and SPACE not in w]
        found = {}
        for w, ids in zip(good, self.sp.encode(good, num_threads=1)):
            if w[0] == "\n":
                if ids[0] != self.space_id:
                    continue
                ids = ids[1:]
            found[w] = np.array(ids, dtype="<u4").tobytes()
        return found

    def _borders_by_words(self, raw: bytes, ids):
        """Original ends of pieces where only spaces changed their length."""
        np = self.np
        ends = np.cumsum(self.size[ids])
        wide = len(self.normal.space)
        spaces = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
        # Where each escaped space ends in the normalised text, after the prefix.
        done = spaces + 1 + wide + (wide - 1) * np.arange(1, len(spaces) + 1)
        return ends - wide - (wide - 1) * np.searchsorted(done, ends, side="right")

    def encode(self, texts: list[str], begin: bool = True, end: bool = True) -> list[tuple[bytes, bytes]]:
        """Per text: ids, and the original byte where each id's span ends,
        both little-endian unsigned 32-bit."""
        np = self.np
        joined = self.cache.encode([words_of(t) for t in texts]) if self.cache else [None] * len(texts)
        out = []
        for t, have in zip(texts, joined):
            raw = t.encode()
            if not t:
                ids, ends = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
            elif have is not None:
                ids = np.frombuffer(have, dtype="<u4")
                ends = self._borders_by_words(raw, ids)
            else:
                names = self.sp.encode(t, out_type=str)
                ids = np.array([self.sp.piece_to_id(p) for p in names], dtype="<u4")
                size = [1 if p in self.bytes else len(p.encode()) for p in names]
                normal, origin = self.normal(raw)
                assert len(normal) == sum(size)
                ends = np.array(origin, dtype=np.int64)[np.cumsum(size, dtype=np.int64)] if size else np.zeros(0, dtype=np.int64)
            if begin:
                ids, ends = np.concatenate(([self.sp.bos_id()], ids)), np.concatenate(([0], ends))
            if end:
                ids, ends = np.concatenate((ids, [self.sp.eos_id()])), np.concatenate((ends, [len(raw)]))
            out.append((ids.astype("<u4").tobytes(), ends.astype("<u4").tobytes()))
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        return [self.sp.decode(self.np.frombuffer(x, dtype="<u4").tolist()) for x in ids]


def pieces(path: str) -> Pieces:
    return worker_state(("pieces", path), lambda: Pieces(path))


def encoded(docs: DataFrame, columns: list[str], text_col: str = "text", model: str | None = None,
            begin: bool = True, end: bool = True, decode: bool = True) -> DataFrame:
    """``columns`` and: ids binary and ends binary (little-endian unsigned
    32-bit integers: the ids, and the byte of the original text where each
    id's span ends; it begins where the one before ends), decoded string (the library's decode(ids)).
    A column named like one of these is returned as ``given_<name>``."""
    path = model or model_path()
    small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        coder = pieces(path)
        for b in batches:
            last = b.num_columns - 1
            for s, e in batches_of(b.column(last), 1 << 20):
                part = b.slice(s, e - s)
                both = coder.encode(part.column(last).to_pylist(), begin, end)
                ids = [x for x, _ in both]
                back = coder.decode(ids) if decode else [None] * len(ids)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ids, pa.binary()), pa.array([x for _, x in both], pa.binary()), pa.array(back, pa.string())],
                    [*part.schema.names[:-1], "ids", "ends", "decoded"])

    given = docs.select(*asked_for(columns, RESULTS), text_or_empty(text_col).alias("__text"))
    return given.mapInArrow(run, fields(given, given.columns[:-1], "ids binary, ends binary, decoded string"))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    e = encoded(table(spark, sf_dir, "documents"), ["doc_id"])
    return e.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), F.sha2("ends", 256).alias("ends_sha256"))
