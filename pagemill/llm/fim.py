"""Fill-in-the-middle by piece tables: documents become descriptors, and only those are moved.

A piece is (buffer, start, length) over one of two immutable buffers of bytes: the document
and the sentinels. Cutting splits the one piece of a document into prefix, middle and suffix
at line ends; a form permutes the three and puts a sentinel before each; the inverse
permutation of the pieces of an arranged text gives the document back. A digest is fed piece by
piece, so that neither the arranged nor the restored text has to be put together for it.

The choices for a document come from a digest of the seed and its id, so they do not depend on
the order or partitioning of rows: no shuffle, and a repeated task decides the same.

Defined results: a null text is an empty one; a null id chooses like an empty string; rows
with one id choose alike, each for its own text; an empty text, and one that contains a sentinel, stays plain; a text without
line breaks is one line, so that two of its parts at least are empty. Texts are read whole; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.llm.worker import travels

travels(__name__)

TEXT, MARKS = 0, 1
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
#: Order of the parts of each form.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

PIECES = "array<struct<buffer:int,start:bigint,length:bigint>>"
_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
FOLDED = (
    f"struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,pieces:{PIECES},"
    "output_sha256:string,restored_sha256:string>"
)
_FOLDED = pa.struct([
    ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("pieces", _PIECES), ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
])


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def view(pieces: Iterable[Piece], buffers: tuple) -> Iterable[memoryview]:
    """The bytes of the pieces, without copying them."""
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest(pieces: Iterable[Piece], buffers: tuple) -> str:
    """sha256 of the text that the pieces make up."""
    state = hashlib.sha256()
    for part in view(pieces, buffers):
        state.update(part)
    return state.hexdigest()


def line_ends(data: memoryview) -> np.ndarray:
    """Where each line ends, its line break included, with 0 in front; the last line may lack the break."""
    after = np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n")) + 1
    whole = not len(data) or (len(after) and after[-1] == len(data))
    return np.concatenate([[0], after, [] if whole else [len(data)]]).astype(np.int64)


def code_points(data: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


class Folded(NamedTuple):
    n: int
    form: str
    cuts: tuple[int, int] | None
    pieces: list[Piece]


class FillInMiddle:
    """The transformation with its sentinels (prefix, suffix, middle), rates in percent and seed.

    Of all documents `rate` percent are transformed, of these `spm` percent with the suffix
    first. A sentinel may not hold another one, nor begin with what one ends with: then no
    sentinel is found in an arranged text where none was put.
    """

    def __init__(
        self, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"), rate: int = 100, spm: int = 50, seed: int = 7
    ) -> None:
        coded = [m.encode() for m in marks]
        for a in coded:
            for b in coded:
                if not a or (a is not b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError("sentinels must differ and must not overlap")
        if len(set(coded)) < 3:
            raise ValueError("sentinels must differ and must not overlap")
        self.rate, self.spm, self.seed = rate, spm, seed
        self._buffer = b"".join(coded)
        starts = np.cumsum([0, *map(len, coded)]).tolist()
        prefix, suffix, middle = (Piece(MARKS, s, len(m)) for s, m in zip(starts, coded))
        self._marks = {PREFIX: prefix, SUFFIX: suffix, MIDDLE: middle}
        self._coded = dict(zip((PREFIX, SUFFIX, MIDDLE), coded))

    def buffers(self, data: memoryview) -> tuple[memoryview, memoryview]:
        return data, memoryview(self._buffer)

    def fold(self, key: int | None, data: memoryview) -> Folded:
        """The pieces of one document in their new order."""
        ends = line_ends(data)
        n, whole = len(ends) - 1, [Piece(TEXT, 0, len(data))]
        drawn = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(drawn[8 * i : 8 * i + 8], 16) for i in range(4))
        if not n or h3 % 100 >= self.rate or self._marked(data):
            return Folded(n, "plain", None, whole)
        a, b = sorted((int(ends[h1 % (n + 1)]), int(ends[h2 % (n + 1)])))
        parts = Piece(TEXT, 0, a), Piece(TEXT, a, b - a), Piece(TEXT, b, len(data) - b)
        form = "spm" if h4 % 100 < self.spm else "psm"
        return Folded(n, form, (a, b), [p for part in FORMS[form] for p in (self._marks[part], parts[part])])

    def _marked(self, data: memoryview) -> bool:
        text = bytes(data)
        return any(mark in text for mark in self._coded.values())

    def unfold(self, output: bytes, form: str) -> list[Piece]:
        """The pieces of an arranged text in the order of the document it was made from."""
        if form not in FORMS:
            return [Piece(TEXT, 0, len(output))]
        order, at, found = FORMS[form], 0, []
        starts = []
        for part in order:
            place = output.index(self._coded[part], at)
            starts.append((place, at := place + len(self._coded[part])))
        for (_, begin), (end, _) in zip(starts, [*starts[1:], (len(output), 0)]):
            found.append(Piece(TEXT, begin, end - begin))
        inverse = sorted(range(len(order)), key=order.__getitem__)
        return [found[i] for i in inverse]

    def apply(self, key: Column, text: Column) -> Column:
        """struct of the lines of a document, its form, sizes in code points, pieces (in bytes of
        UTF-8), the digest of the arranged text, and that of the text rebuilt from it."""

        @F.arrow_udf(returnType=FOLDED)
        def folded(keys: pa.Array, texts: pa.Array) -> pa.Array:
            return pa.array([self._row(k.as_py(), _bytes(t)) for k, t in zip(keys, texts.cast(pa.binary()))], _FOLDED)

        return folded(key, text)

    def _row(self, key: int | None, data: memoryview) -> dict:
        n, form, cuts, pieces = self.fold(key, data)
        buffers = self.buffers(data)
        output = b"".join(view(pieces, buffers))
        return {
            "n": n,
            "form": form,
            "prefix_chars": cuts and code_points(data[: cuts[0]]),
            "middle_chars": cuts and code_points(data[cuts[0] : cuts[1]]),
            "pieces": [p._asdict() for p in pieces],
            "output_sha256": digest(pieces, buffers),
            "restored_sha256": digest(self.unfold(output, form), self.buffers(memoryview(output))),
        }

    def render(self, text: Column, pieces: Column) -> Column:
        """string: the arranged text of a document and its pieces."""

        @F.arrow_udf(returnType="string")
        def rendered(texts: pa.Array, lists: pa.Array) -> pa.Array:
            out = []
            for text, of in zip(texts.cast(pa.binary()), lists):
                out.append(b"".join(view([Piece(**p) for p in of.as_py() or []], self.buffers(_bytes(text)))))
            return pa.array(out, pa.binary()).cast(pa.string())

        return rendered(text, pieces)

    def restore(self, output: Column, form: Column) -> Column:
        """string: the document of an arranged text and its form; null without an output."""

        @F.arrow_udf(returnType="string")
        def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
            out = []
            for output, form in zip(outputs.cast(pa.binary()), forms):
                text = output.as_py()
                if text is not None:
                    text = b"".join(view(self.unfold(text, form.as_py()), self.buffers(memoryview(text))))
                out.append(text)
            return pa.array(out, pa.binary()).cast(pa.string())

        return restored(output, form)


def _bytes(value: pa.Scalar) -> memoryview:
    """The bytes of a value in its Arrow buffer; none for null."""
    return memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")
