"""Operator 13: byte-level BPE encoding and decoding by a sentencepiece model.

A byte-level BPE vocabulary (tokens as bytes, with ranks) is written directly as
a sentencepiece BPE model: every byte becomes one visible character, a token
is the piece of its bytes' characters with the negative rank as score, and
the normaliser changes nothing.  Merging the best scored pair first is then
merging the lowest rank first, ties from left to right in both, so each match of
the splitting pattern (a pre-token) is encoded by the model on its own and
its ids are the ranks.  Decoding maps ids to bytes and the bytes back to text.

Words repeat, so each worker keeps a bounded memo of units: white space and what
follows up to the next.  No pre-token reaches from a character into white space behind it,
so units are split and encoded apart from each other.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import struct
import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, text_or_empty

#: Units of more characters are not kept in the memo.
LONG = 64
#: A piece no text holds: its characters are outside the byte alphabet.
UNKNOWN = "\u2047\u2047"
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(rf"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++")


def byte_alphabet() -> str:
    """A visible character for each byte: itself in Latin-1 if it has a shape of its own there, else one of the next free code points from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in set(shown) else chr(next(spare)) for b in range(256))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def model_proto(tokens: Sequence[bytes], ranks: Sequence[int]) -> bytes:
    """The serialised sentencepiece model: piece i is token i, scored by its negative rank; the unknown piece comes last."""
    alphabet = byte_alphabet()
    normal, unknown, bpe = 1, 2, 2

    def piece(text: str, score: float, kind: int) -> bytes:
        return _message(1, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    out = [piece("".join(alphabet[b] for b in t), -r, normal) for t, r in zip(tokens, ranks, strict=True)]
    out.append(piece(UNKNOWN, 0.0, unknown))
    trainer = _number(3, bpe) + _number(4, len(out)) + _number(40, len(tokens)) + _message(45, UNKNOWN.encode())
    identity = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _message(2, trainer) + _message(3, identity)


def other_classes() -> dict[int, str]:
    """Code points that the pattern engine of the tiktoken library and that of ``regex`` class differently, with one that ``regex`` puts where tiktoken does.

    The two hold different versions of Unicode; which letters and numbers
    tiktoken knows is asked of itself, by an encoding that has single bytes only.
    """
    import tiktoken

    every = "".join([chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000])
    out: dict[int, str] = {}
    known: set[str] = set()
    for pattern, stand_in in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " ")):
        single = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs, ours = set(bytes(single.encode_ordinary(every)).decode()), set(regex.findall(pattern, every))
        out |= {ord(c): stand_in for c in theirs - ours}
        out |= {ord(c): "!" for c in ours - theirs if c not in known and ord(c) not in out}
        known |= theirs
    return out


class ByteModel:
    """Encoder and decoder over a rank file and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import sentencepiece

        if not all(ranks.get(bytes([b])) is not None for b in range(256)):
            raise ValueError("a vocabulary with all single bytes is needed")
        if max(ranks.values()) > 1 << 24:
            raise ValueError("ranks beyond 2**24 are not exact as scores")
        self.tokens, values = zip(*sorted(ranks.items(), key=lambda x: x[1]), strict=True)
        self.bytes_of = dict(zip(values, self.tokens, strict=True))
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.tokens, values))
        self.id_bytes = [v.to_bytes(4, "little") for v in values]  # of piece i
        self.to_pieces = dict(enumerate(byte_alphabet()))
        self.pattern = regex.compile(pattern)
        self.other = other_classes()
        self.alike = frozenset(chr(c) for c in range(0x800) if c not in self.other)
        # tokens that are taken whole though merging does not lead to them
        own = self.library.encode([self.mapped(t) for t in self.tokens], num_threads=1)
        self.whole = {t: k for k, t in enumerate(self.tokens) if own[k] != [k]}

    def mapped(self, data: bytes) -> str:
        text = data.decode("latin-1")
        return text.replace(" ", self.to_pieces[32]) if text.isascii() and text.isprintable() else text.translate(self.to_pieces)

    def pre_tokens(self, unit: str) -> list[str]:
        """The matches of the pattern, as the tiktoken library finds them."""
        if not unit.isascii() and not self.alike.issuperset(unit) and (like := unit.translate(self.other)) != unit:
            return [unit[m.start():m.end()] for m in self.pattern.finditer(like)]
        return self.pattern.findall(unit)

    def encode_pre_tokens(self, pre_tokens: list[str]) -> list[list[int]]:
        """Pieces of every pre-token."""
        found = self.library.encode([self.mapped(p.encode()) for p in pre_tokens], num_threads=1)
        if self.whole:
            found = [[self.whole[d]] if (d := p.encode()) in self.whole else ids for p, ids in zip(pre_tokens, found, strict=True)]
        return found

    def encode(self, text: str) -> list[int]:
        found = self.encode_pre_tokens([p for u in UNIT.findall(text) for p in self.pre_tokens(u)])
        return [int.from_bytes(self.id_bytes[i], "little") for pieces in found for i in pieces]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteModel:
    return ByteModel(read_ranks(path), pattern)


class Memo:
    """Units as the bytes of their ids; decoded, where they are not the unit again."""

    def __init__(self, model: ByteModel, size: int):
        self.model, self.size = model, size
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, bytes] = {}

    def learn(self, met: set[str]) -> list[str]:
        """Take in the units of a batch; returns new ones that are too long to be kept."""
        new = [u for u in met if u not in self.ids]
        if len(self.ids) + len(new) > self.size:
            self.ids, self.text, new = {}, {}, list(met)
        model = self.model
        cut = [self.model.pre_tokens(u) for u in new]
        pre_tokens = list(set().union(*cut))
        id_bytes, tokens = model.id_bytes, model.tokens
        known, odd = {}, {}
        for p, pieces in zip(pre_tokens, model.encode_pre_tokens(pre_tokens), strict=True):
            known[p] = b"".join([id_bytes[i] for i in pieces])
            back = b"".join([tokens[i] for i in pieces])
            if back != p.encode():
                odd[p] = back
        self.ids.update(zip(new, [known[c[0]] if len(c) == 1 else b"".join([known[p] for p in c]) for c in cut], strict=True))
        if odd:
            self.text |= {u: b"".join([odd.get(p, p.encode()) for p in c]) for u, c in zip(new, cut, strict=True) if not odd.keys().isdisjoint(c)}
        return [u for u in new if len(u) > LONG]

    def forget(self, units: list[str]) -> None:
        for u in units:
            del self.ids[u]
            self.text.pop(u, None)


@lru_cache(maxsize=1)
def memo_of(path: str, pattern: str, size: int) -> Memo:
    """A worker's memo: it serves all tasks the worker runs."""
    return Memo(load(path, pattern), size)


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _digest_batches(path: str, pattern: str, memo_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        memo = memo_of(path, pattern, memo_size)
        gc.disable()  # millions of small objects live for one batch, none in a cycle

        def rows():
            for b in batches:
                texts = b.column("text").to_pylist()
                cut = [UNIT.findall(t) for t in texts]
                met = set().union(*cut)
                long = memo.learn(met)
                ids_of, odd = memo.ids, memo.text
                for doc_id, text, units in zip(b.column("doc_id").to_pylist(), texts, cut, strict=True):
                    ids = b"".join([ids_of[u] for u in units])
                    # without odd units, what is decoded is the text
                    back = b"".join([odd[u] if u in odd else u.encode() for u in units]) if odd else text.encode()
                    yield doc_id, len(ids) // 4, sha(ids).hexdigest(), sha(back).hexdigest()
                memo.forget(long)

        try:
            yield from batches_of(rows(), OUT)
        finally:
            gc.enable()

    return run


def encode_digests(docs: DataFrame, path: str, pattern: str, memo_size: int = 500_000) -> DataFrame:
    """Per row: number of ids, digests of the ids (little-endian, 32 bits each) and of the bytes decoded from them.

    ``path`` names a rank file on every executor.  Only ``doc_id`` and ``text``
    are read; repeated rows stay, a null text counts as empty (no ids, no bytes),
    a null ``doc_id`` stays null, an empty table gives no rows; the strings of
    special tokens count as ordinary text.  Map-only: no shuffle, memory bounded
    by one batch and the memo.
    """
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        _digest_batches(path, pattern, memo_size), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ids of every row's text (null text: none); rows and cases as in :func:`encode_digests`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        yield from batches_of(((i, model.encode(t)) for b in batches for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())), IDS, 256)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the text of every row's ``ids`` (null ids: empty text; bytes that are no UTF-8 become the replacement character)."""
    @F.pandas_udf("string")
    def text(ids):
        model = load(path, pattern)
        return ids.map(lambda x: model.decode([int(i) for i in x]) if x is not None else "")

    return encoded.select("doc_id", text("ids").alias("text"))
