"""Operator 12: fill-in-middle transformation by a piece table.

A document is a list of descriptors ``(buffer, start, end)`` over two immutable
buffers: the UTF-8 bytes of its text and those of the sentinels.  Cutting splits
a descriptor, an arrangement permutes the pieces and puts sentinels between
them, and restoring reads the pieces of an output and permutes them
back.  No step copies text: a digest takes the descriptors one after the other,
and bytes are joined only where an output is asked for.

Places for cuts are ends of lines; two hashes of the document's id pick them,
two more pick the form, so reruns agree and no state is shared between rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, rows_of, text_or_empty

PREFIX, SUFFIX, MIDDLE = 0, 1, 2
#: Which parts each form shows, in order; every part follows its sentinel.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
TEXT, MARKS = 0, 1


@dataclass(frozen=True)
class Rule:
    """What is transformed: percent of the documents, percent of those in the form spm, and the sentinels."""
    seed: str = "7"
    rate: int = 100
    spm: int = 50
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")  # of prefix, suffix, middle

    @property
    def marks(self) -> list[bytes]:
        return [s.encode() for s in self.sentinels]


Piece = tuple[int, int, int]


class PieceTable:
    """Descriptors over a text buffer and the buffer of the sentinels."""

    def __init__(self, text: bytes, marks: list[bytes], pieces: list[Piece] | None = None):
        self.buffers = (memoryview(text), memoryview(b"".join(marks)))
        ends = np.cumsum([len(m) for m in marks]).tolist()
        self.mark = [(MARKS, e - len(m), e) for m, e in zip(marks, ends, strict=True)]
        self.pieces = [(TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, at: int) -> None:
        """Split the descriptor that holds place ``at`` of the document there (an end gives an empty piece)."""
        before = 0
        for i, (buffer, start, end) in enumerate(self.pieces):
            if at <= before + end - start:
                middle = start + at - before
                self.pieces[i:i + 1] = [(buffer, start, middle), (buffer, middle, end)]
                return
            before += end - start
        raise ValueError("a place behind the end")

    def arranged(self, form: str) -> PieceTable:
        """Prefix, middle and suffix in the order of a form, each behind its sentinel."""
        part = dict(zip((PREFIX, MIDDLE, SUFFIX), self.pieces, strict=True))
        order = FORMS[form]
        return self._with([p for k in order for p in (self.mark[k], part[k])])

    def restored(self, form: str) -> PieceTable:
        """The inverse: the pieces behind the sentinels, in the order of the text."""
        behind = dict(zip(FORMS[form], self.pieces[1::2], strict=True))
        return self._with([behind[k] for k in (PREFIX, MIDDLE, SUFFIX)])

    def _with(self, pieces: list[Piece]) -> PieceTable:
        other = object.__new__(PieceTable)
        other.buffers, other.mark, other.pieces = self.buffers, self.mark, pieces
        return other

    def chunks(self) -> Iterable[memoryview]:
        return (self.buffers[b][s:e] for b, s, e in self.pieces)

    def digest(self) -> str:
        h = hashlib.sha256()
        for c in self.chunks():
            h.update(c)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.chunks())


def read_output(output: bytes, form: str, marks: list[bytes]) -> PieceTable:
    """An output as a piece table: its sentinels, found in the order of the form, and what follows each.

    A transformed text holds no sentinel of its own, so each stands once.
    """
    pieces: list[Piece] = []
    at = 0
    for k in FORMS[form]:
        mark = marks[k]
        found = output.find(mark, at)
        if found < 0 or (not pieces and found):
            raise ValueError(f"no output of form {form}")
        if pieces:
            pieces[-1] = (TEXT, at, found)
        at = found + len(mark)
        pieces += [(TEXT, found, at), (TEXT, at, len(output))]
    return PieceTable(output, marks, pieces)


def hashes(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers of 32 bits from the SHA-256 of seed and id (a null id: the seed alone)."""
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(x[8 * k:8 * k + 8], 16) for k in range(4)]


def unit_ends(text: bytes) -> np.ndarray:
    """Where each line ends (its line feed included); a text without a last line feed ends with a line as well."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.append(ends, len(text)) if len(text) and (not len(ends) or ends[-1] != len(text)) else ends


def code_points(text: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def transform(doc_id: int | None, text: bytes, rule: Rule, marks: list[bytes]) -> tuple[int, str, PieceTable, PieceTable]:
    """Number of lines, form, the table cut into its parts, the table as arranged."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = hashes(doc_id, rule.seed)
    table = PieceTable(text, marks)
    if not text or h3 % 100 >= rule.rate or any(m in text for m in marks):
        return n, "plain", table, table
    form = "spm" if h4 % 100 < rule.spm else "psm"
    places = np.concatenate(([0], ends))
    for k in sorted((h1 % (n + 1), h2 % (n + 1))):
        table.cut(int(places[k]))
    return n, form, table, table.arranged(form)


def restore(output: bytes, form: str, marks: list[bytes]) -> PieceTable:
    """The text of an output: as it is if plain, else its parts put back."""
    return PieceTable(output, marks) if form == "plain" else read_output(output, form, marks).restored(form)


DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_OUTPUTS = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())])
_TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def _mapped(df: DataFrame, names: list[str], make, out: pa.Schema, ddl: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of((make(*r) for r in rows_of(batches, *names)), out, size)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, ddl)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.encode(text_or_empty(), "UTF-8").alias("text"))


def digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008 -- a frozen value
    """Per row: number of lines, form, code points of prefix and middle, digests of the output and of the text read back from it.

    Only ``doc_id`` and ``text`` are read; a null text counts as empty, an empty
    text and one that holds a sentinel stay plain (parts null); a null id hashes
    the seed alone; repeated rows stay and agree; an empty table gives no rows.
    Map-only: a row is worked on by itself, texts as long as a batch or longer
    alone in one.
    """
    marks = rule.marks

    def make(doc_id: int | None, text: bytes) -> tuple:
        n, form, cut, out = transform(doc_id, text, rule, marks)
        parts = (None, None) if form == "plain" else [code_points(c) for c in list(cut.chunks())[:2]]
        return doc_id, n, form, *parts, out.digest(), restore(out.bytes(), form, marks).digest()

    return _mapped(_rows(docs), ["doc_id", "text"], make, _DIGESTS, DIGESTS, 4096)


def outputs(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """``doc_id, form, output`` of every row; rows and cases as in :func:`digests`."""
    marks = rule.marks

    def make(doc_id: int | None, text: bytes) -> tuple:
        _, form, _, out = transform(doc_id, text, rule, marks)
        return doc_id, form, out.bytes().decode()

    return _mapped(_rows(docs), ["doc_id", "text"], make, _OUTPUTS, "doc_id long, form string, output string", 256)


def texts(transformed: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """``doc_id, text`` from ``doc_id, form, output``: the inverse of :func:`outputs`.

    A null output counts as empty, a null form as plain; an output that does not have its form is an error.
    """
    marks = rule.marks

    def make(doc_id: int | None, form: str, output: bytes) -> tuple:
        return doc_id, restore(output, form, marks).bytes().decode()

    rows = transformed.select("doc_id", F.coalesce("form", F.lit("plain")).alias("form"), F.encode(text_or_empty("output"), "UTF-8").alias("output"))
    return _mapped(rows, ["doc_id", "form", "output"], make, _TEXTS, "doc_id long, text string", 256)
