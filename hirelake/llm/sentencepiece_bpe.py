"""Operator 10: SentencePiece encoding and decoding of merge-type vocabularies.

A segment is encoded by a score-ordered agenda of adjacent symbol pairs: the
best scored pair that forms a piece is merged first, ties from left to right,
entries whose symbols have changed are dropped.  Merges never cross a place
whose two characters stand side by side in no piece, so a text is cut there
into segments (word marks and letters, or other characters) that are encoded
on their own; the cut is checked against the vocabulary when a model is loaded.

Words repeat, so each worker keeps a bounded memo of units (word marks and what
follows up to the next).  The segments of the units that are new in an Arrow
batch run through their agendas together, one step of each segment at a time,
in NumPy; long ones use a heap.  All new units are also encoded and decoded by
the sentencepiece library, in one call for a batch; where the two differ the
library's result is kept and the unit is counted in ``n_disagree`` (0 expected).
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, text_or_empty

MARK = "▁"
#: Segments of more characters go to the heap and are not kept in the memo.
LONG = 64
NO_PAIR = np.int64(1 << 30)


class PieceModel:
    """Own encoder and decoder over the pieces and scores of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.merge: dict[str, tuple[float, int]] = {}
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                value = int(p[3:5], 16)
                self.byte_id[value], self.byte_of[i] = i, value
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.merge[p] = (sp.get_score(i), i)
        if len(self.byte_id) != 256 or any(sp.is_unused(i) for i in range(n)):
            raise ValueError("a merge-type model with byte fallback and no unused pieces is needed")
        probe = "  ﬁ\u3000x "
        if sp.decode(sp.encode(probe)) != probe:
            raise ValueError("the model normalises its input")
        self.cut = self._cut()
        self._pairs()
        self.shown = [str(i) for i in range(n)]

    def _cut(self) -> re.Pattern:
        """The pattern of segments: one that cuts no piece."""
        apart: set[str] = set()  # letters that pieces put beside other characters
        for p in self.merge:
            for x, y in zip(p, p[1:]):
                if MARK not in (x, y) and (x.isalpha() or x.isalnum() and not x.isdecimal()) != (y.isalpha() or y.isalnum() and not y.isdecimal()):
                    apart |= {c for c in (x, y) if c.isalnum()}
        letters = f"[^\\W\\d_{re.escape(''.join(sorted(apart)))}]"
        other = f"[\\W\\d_{re.escape(''.join(sorted(apart)))}]"
        cut = re.compile(f"{MARK}*{letters}+|{MARK}*(?:(?!{MARK}){other})+|{MARK}+")
        marks_only = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        for pattern in (cut, marks_only):
            if all(len(pattern.findall(p)) == 1 for p in self.merge):
                return pattern
        raise ValueError("a piece crosses words")

    def _pairs(self) -> None:
        """Every pair of symbols that forms a piece, as sorted keys with rank (by score) and piece."""
        n = len(self.pieces)
        self.symbol_of = np.arange(n, n + 0x110000, dtype=np.int64)  # of a code point; one that is no piece has an own number
        for p, (_, i) in self.merge.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        rank = {s: k for k, s in enumerate(sorted({s for s, _ in self.merge.values()}, reverse=True))}

        def symbol(x: str) -> int | None:
            return self.merge[x][1] if x in self.merge else int(self.symbol_of[ord(x)]) if len(x) == 1 else None

        rows = []
        for p, (score, i) in self.merge.items():
            for k in range(1, len(p)):
                a, b = symbol(p[:k]), symbol(p[k:])
                if a is not None and b is not None:
                    rows.append((a << 21 | b, rank[score], i))
        rows.sort()
        self.pair_key, self.pair_rank, self.pair_piece = (np.array(c, dtype=np.int64) for c in zip(*rows))

    def segments(self, text: str) -> list[str]:
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def ids_of(self, symbol: int) -> list[int]:
        """A symbol's ids: itself if it is a piece, else its bytes'."""
        n = len(self.pieces)
        return [symbol] if symbol < n else [self.byte_id[b] for b in chr(symbol - n).encode("utf-8")]

    def encode_segment(self, segment: str) -> list[int]:
        """One segment, its agenda in a heap."""
        merge = self.merge
        symbols: list[str] = list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < n:
                both = symbols[left] + symbols[right]
                if both in merge:
                    heapq.heappush(agenda, (-merge[both][0], left, right, both))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(both):
                continue  # one of the two was merged since
            symbols[left], symbols[right] = both, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            propose(before[left], left)
            propose(left, after[left])
        ids: list[int] = []
        for s in symbols:
            if s:
                ids.extend([merge[s][1]] if s in merge else [self.byte_id[b] for b in s.encode("utf-8")])
        return ids

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 21 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        found = self.pair_key[at] == key
        return np.where(found, self.pair_rank[at], NO_PAIR), self.pair_piece[at]

    def encode_segments(self, segments: list[str], together: int = 8192) -> list[list[int]]:
        """Many segments, so many together that their agendas fit the cache."""
        return [ids for k in range(0, len(segments), together) for ids in self._encode_together(segments[k:k + together])]

    def _encode_together(self, segments: list[str]) -> list[list[int]]:
        """Each step takes the best entry of every segment's agenda."""
        out: list[list[int]] = [[] for _ in segments]
        short = [k for k, s in enumerate(segments) if len(s) <= LONG]
        for k, s in enumerate(segments):
            if len(s) > LONG:
                out[k] = self.encode_segment(s)
        if not short:
            return out
        owner = np.array(short)
        size = np.array([len(segments[k]) for k in short])
        text = "".join([segments[k] for k in short])
        sym = self.symbol_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        rank, piece = self._rank(sym, np.append(sym[1:], 0))
        rank[np.cumsum(size) - 1] = NO_PAIR  # the last symbol of a segment has no right neighbour
        pieces = len(self.pieces)
        while len(owner):
            start = np.cumsum(size) - size
            best = np.minimum.reduceat(rank << 32 | np.arange(len(sym)), start)
            ended = best >> 32 == NO_PAIR
            if ended.any():
                mine = np.repeat(ended, size)
                done, at = sym[mine].tolist(), 0
                for k, n in zip(owner[ended].tolist(), size[ended].tolist()):
                    ids = done[at:at + n]
                    at += n
                    out[k] = ids if max(ids) < pieces else [i for x in ids for i in self.ids_of(x)]
                sym, rank, piece = sym[~mine], rank[~mine], piece[~mine]
                owner, size, best = owner[~ended], size[~ended], best[~ended]
                if not len(owner):
                    break
                shift = np.cumsum(size) - size - start[~ended]
                at = (best & 0xFFFFFFFF) + shift
            else:
                at = best & 0xFFFFFFFF
            sym[at] = piece[at]
            last = rank[at + 1]  # no right neighbour if the swallowed symbol had none
            size = size - 1
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            ends = np.zeros(len(sym), bool)
            stop = np.cumsum(size + 1) - 1
            ends[stop] = True
            ends[at] |= ends[at + 1]
            sym, rank, piece, ends = sym[stay], rank[stay], piece[stay], ends[stay]
            at = at - np.arange(len(at))  # one symbol fewer in each segment before
            start = np.cumsum(size) - size
            for where in (at[~ends[at]], at[at > start] - 1):
                rank[where], piece[where] = self._rank(sym[where], sym[where + 1])
            rank[ends] = NO_PAIR
        return out

    def decode_pieces(self, ids: list[int]) -> str:
        """The characters of the pieces, word marks as spaces; runs of byte pieces are read as UTF-8."""
        pieces = self.pieces
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([pieces[i] for i in ids]).replace(MARK, " ")
        out: list[str] = []
        held = bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(pieces[i].replace(MARK, " "))
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_segments(self.segments(text)) for i in ids]

    def decode(self, ids: list[int]) -> str:
        return self.decode_pieces(ids)[1:] if ids else ""  # without the mark put before the text


@lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    return PieceModel(path)


UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def units(text: str) -> list[str]:
    """The text cut before each run of word marks, every unit without its first mark."""
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [u[1:] for u in UNIT.findall(MARK + text.replace(" ", MARK))]


class Memo:
    """Encodings of units, checked against the library when they are first met."""

    def __init__(self, model: PieceModel, size: int):
        self.model, self.size, self.disagree = model, size, 0
        self.ids: dict[str, str] = {}  # of a unit, comma-joined
        self.text: dict[str, str] = {}  # decoded, where it is not the unit itself

    def learn(self, met: set[str]) -> None:
        new = [u for u in met if u not in self.ids]
        if len(self.ids) + len(new) > self.size:
            self.ids, self.text, new = {}, {}, list(met)
        if not new:
            return
        model, lib, shown = self.model, self.model.library, self.model.shown
        cut = [model.cut.findall(MARK + u) for u in new]
        segments = list(set().union(*cut))
        known = dict(zip(segments, model.encode_segments(segments)))
        own = [known[c[0]] if len(c) == 1 else [i for s in c for i in known[s]] for c in cut]
        plain = [u.replace(MARK, " ") for u in new]
        theirs = lib.encode(plain, num_threads=1)
        back = lib.decode(own, num_threads=1)
        for u, text, ids, ref, ref_text in zip(new, plain, own, theirs, back):
            got = model.decode(ids)
            if u and (ids != ref or got != ref_text):  # the library encodes an empty text, not a lone mark, to nothing
                self.disagree += 1
                ids = ref
                got = lib.decode(ref)
            self.ids[u] = ",".join([shown[i] for i in ids])
            if got != text:
                self.text[u] = got

    def forget_long(self, met: set[str]) -> None:
        for u in [u for u in met if len(u) > LONG]:
            del self.ids[u]
            self.text.pop(u, None)


def encode_batches(path: str, memo_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sha = load(path), hashlib.sha256
        memo = Memo(model, memo_size)
        gc.disable()  # millions of small lists live for one batch, none in a cycle

        def rows():
            for b in batches:
                texts = b.column("text").to_pylist()
                cut = [units(t) for t in texts]
                met = set().union(*cut)
                memo.learn(met)
                known, odd = memo.ids, memo.text
                for doc_id, text, us in zip(b.column("doc_id").to_pylist(), texts, cut):
                    ids = ",".join([known[u] for u in us])
                    if odd:
                        text = " ".join([odd[u] if u in odd else u.replace(MARK, " ") for u in us])
                    else:  # every unit met so far decodes to itself
                        text = text.replace(MARK, " ")
                    n = ids.count(",") + 1 if ids else 0
                    yield (doc_id, n, sha(ids.encode()).hexdigest(), sha(text.encode()).hexdigest(), memo.disagree)
                    memo.disagree = 0
                memo.forget_long(met)

        try:
            yield from batches_of(rows(), OUT)
        finally:
            gc.enable()

    return run


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                 ("decoded_sha256", pa.string()), ("n_disagree", pa.int64())])
IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode_digests(docs: DataFrame, path: str, memo_size: int = 500_000) -> DataFrame:
    """Per row: number of ids, digests of the ids and of the decoded text.

    ``path`` names the model file on every executor.  Only ``doc_id`` and
    ``text`` are read; repeated rows stay, a null text counts as empty (no ids,
    empty text), a null ``doc_id`` stays null, an empty table gives no rows.
    Map-only: no shuffle, memory bounded by one batch and the memo.
    """
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        encode_batches(path, memo_size),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_disagree long")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the ids of every row's text (null text: none)."""
    def run(batches):
        model = load(path)

        def rows():
            for b in batches:
                cut = [model.segments(t) for t in b.column("text").to_pylist()]
                new = list(set().union(*cut))
                ids = dict(zip(new, model.encode_segments(new)))
                for doc_id, segments in zip(b.column("doc_id").to_pylist(), cut):
                    yield doc_id, [i for s in segments for i in ids[s]]
        yield from batches_of(rows(), IDS, 256)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the text of every row's ``ids`` (null ids: empty text)."""
    @F.pandas_udf("string")
    def text(ids):
        model = load(path)
        return ids.map(lambda x: model.decode([int(i) for i in x]) if x is not None else "")

    return encoded.select("doc_id", text("ids").alias("text"))
