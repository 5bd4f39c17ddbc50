"""Byte-level BPE encoding and decoding through a piece model made from the ranks.

The rank file is serialised straight into a BPE piece model: each token's bytes become one
printable character per byte, its score is its negative rank, and normalisation is the
identity.  Merging the best-scored adjacent pair is then merging the lowest-ranked one.
Each match of the split pattern is encoded by itself; ids map back to bytes by the
inverse table.

Pre-tokens repeat heavily, so each worker keeps what it has encoded, in a table of bounded
size that only ever saves work.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from touchline.llm.common import texts_of, with_arrow_columns

#: Bytes that each of the two generations a worker remembers may take, and the longest cut in them (characters).
REMEMBERED_BYTES, LONG_CUT = 48 << 20, 64
_ENTRY = 300  # bytes of an entry besides its text, ids and bytes
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af"
#: Cheap cuts at places where a match of the pattern always ends: after a run of letters that ASCII
#: punctuation, white space or the end follows, and around white space but for one leading blank.
#: The full pattern then runs on each cut that is not plainly one run of letters.
_CUT = re.compile(rf" ?[{_LETTER}]+(?![^\x00-@\[-`{{-\x7f])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Alternatives that a pattern must have for these cuts to be safe; other patterns split the whole text.
_CUTTABLE = {r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+(?!\S)", r"\s+"}
#: Characters of text whose new cuts are encoded in one call.
_TOGETHER = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and number per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where printable, else from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    """One field of a protocol buffer message: bytes or text, float, or a number."""
    if isinstance(value, (bytes, str)):
        data = value.encode() if isinstance(value, str) else value
        return _varint(number << 3 | 2) + _varint(len(data)) + data
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def piece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE piece model: id 0 unknown (never produced), id r + 1 the r-th token."""
    chars = byte_characters()
    ordered = sorted(ranks, key=ranks.__getitem__)
    unknown = _field(1, "⁇") + _field(2, 0.0) + _field(3, 2)
    pieces = [_field(1, "".join(chars[b] for b in token)) + _field(2, -float(ranks[token])) for token in ordered]
    trainer = _field(3, 2) + _field(4, len(ordered) + 1)  # model type BPE, size
    trainer += _field(40, 0) + _field(41, -1) + _field(42, -1) + _field(43, -1) + _field(45, "⁇")
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, keep blanks as they are
    return b"".join(_field(1, p) for p in [unknown, *pieces]) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encoder and decoder over one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = [None, *map(ranks.__getitem__, tokens)]  # by piece id; 0 is the unknown piece
        self.bytes_of = dict(zip(self.ids[1:], tokens))
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_model(ranks))
        self.split = regex.compile(pattern).findall
        self.cut = _CUT.findall if _CUTTABLE <= {*pattern.split("|")} else self.split
        self.to_char = dict(enumerate(byte_characters()))
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}
        self.size = 0  # of what is known, in bytes

    def encode_pretokens(self, pretokens: list[str]) -> list[list[int]]:
        mapped = [p.encode().decode("latin-1").translate(self.to_char) for p in pretokens]
        ids = self.ids
        return [[ids[i] for i in found] for found in self.model.encode(mapped, num_threads=1)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _pretokens(self, cut: str) -> list[str]:
        """What the pattern makes of a cut; a run of letters, with or without a blank before it, is one match."""
        if self.cut is self.split or cut.isalpha() or cut[0] == " " and cut[1:].isalpha():
            return [cut]
        return self.split(cut)

    def _learn(self, cuts: list[str]) -> None:
        again = [c for c in cuts if c in self.older]
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        cuts = [c for c in cuts if c not in self.older]
        parts = [self._pretokens(c) for c in cuts]
        found = iter(self.encode_pretokens([p for part in parts for p in part]))
        for cut, part in zip(cuts, parts):
            ids = next(found) if len(part) == 1 else [i for _ in part for i in next(found)]
            self.known[cut] = " ".join(map(str, ids)), len(ids), self.decode(ids)
        self.size += sum(_ENTRY + len(self.known[c][0]) + 5 * len(c) for c in cuts) + _ENTRY * len(again)

    def _encode_long(self, cut: str) -> tuple[str, int, bytes]:
        """As ``_learn`` for one long cut, which is not kept."""
        ids = [i for found in self.encode_pretokens(self._pretokens(cut)) for i in found]
        return " ".join(map(str, ids)), len(ids), self.decode(ids)

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """For each text: decimal ids joined by one space, their number, and the bytes they decode to."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= _TOGETHER):
                chars += len(texts[end])
                end += 1
            if self.size > REMEMBERED_BYTES:
                self.known, self.older, self.size = {}, self.known, 0
            cuts = [self.cut(t) for t in texts[at:end]]
            self._learn([c for c in set().union(*cuts) if len(c) <= LONG_CUT and c not in self.known])
            for own in cuts:
                rows = [self.known[c] if len(c) <= LONG_CUT else self._encode_long(c) for c in own]
                ids, counts, decoded = zip(*rows) if rows else ((), (), ())
                yield " ".join(ids), sum(counts), b"".join(decoded)
            at = end


def bpe_table(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of each whole text.

    A null text is read as empty: no tokens, digests of the empty text.  Repeated rows give
    repeated rows, null keys pass through, an empty table gives an empty result; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: its size does not follow the data
    made: list[ByteBpe] = []

    def compute(batch: pa.RecordBatch) -> list:
        if not made:
            made.append(ByteBpe(shared.value, pattern))
        rows = []
        for ids, n, decoded in made[0].encode_texts(texts_of(batch, text)):
            rows.append((n, sha256(ids.encode()).hexdigest(), sha256(decoded).hexdigest()))
        return list(zip(*rows))

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return with_arrow_columns(docs.select(key, text), fields, compute, keep=[key])


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with one more column, tl_ids: the token ids of each text as an array."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    made: list[ByteBpe] = []

    def compute(batch: pa.RecordBatch) -> list:
        if not made:
            made.append(ByteBpe(shared.value, pattern))
        return [[list(map(int, ids.split())) for ids, _, _ in made[0].encode_texts(texts_of(batch, text))]]

    return with_arrow_columns(docs, [T.StructField("tl_ids", T.ArrayType(T.IntegerType()))], compute)
