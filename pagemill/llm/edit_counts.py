"""Token counts that follow edits without encoding a document again.

The pieces of the pre-tokenizer carry a document's count. They are the leaves of a segment
tree whose nodes hold sums of characters and tokens. An edit drops the leaves it touches, and
those before it whose end was decided by characters of the edit; the text there is split
again until a boundary after the edit falls on an old one. From such a boundary on the old
pieces stand, for the pattern looks ahead only. Sums change along the paths to the new leaves.

Special tokens in a text count as ordinary text. Defined results: null text counts as
empty, null edits as none; a null place, length or insertion as 0 or empty; places beyond
the end are at the end, negative ones at the start; edits are applied one after
another, each to the text the one before it left; every row gives a row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.bpe import BytePairCodec, codec
from pagemill.llm.worker import travels

travels(__name__)

#: Leaves in a bottom node, and children of an inner node, after building.
FAN = 32
#: Characters before an edit that may have decided where a piece ends: the end of a run of
#: blanks looks at the character after it, and gives back one.
CONTEXT = 2
#: Characters that are split at a time while looking for an old boundary.
STRIDE = 256


class Node:
    """Sums of characters and tokens over pieces, in leaves (chars, tokens) or in child nodes."""

    __slots__ = ("chars", "tokens", "children", "leaves")

    def __init__(self, children: list[Node] | None = None, leaves: list[tuple[int, int]] | None = None) -> None:
        self.children, self.leaves = children, leaves
        self.add_up()

    def add_up(self) -> None:
        if self.leaves is not None:
            self.chars = sum(c for c, _ in self.leaves)
            self.tokens = sum(t for _, t in self.leaves)
        else:
            self.chars = sum(n.chars for n in self.children)
            self.tokens = sum(n.tokens for n in self.children)


def build(leaves: list[tuple[int, int]]) -> Node:
    level = [Node(leaves=leaves[i : i + FAN]) for i in range(0, len(leaves), FAN)] or [Node(leaves=[])]
    while len(level) > 1:
        level = [Node(children=level[i : i + FAN]) for i in range(0, len(level), FAN)]
    return level[0]


class CountedText:
    """A text, its pieces as a segment tree, and how many characters were encoded so far."""

    def __init__(self, codec_: BytePairCodec, text: str) -> None:
        self._codec, self.text, self.encoded = codec_, text, 0
        self._root = build(self._counted(codec_.split(text)))

    @property
    def n_tokens(self) -> int:
        return self._root.tokens

    def _counted(self, pieces: list[str]) -> list[tuple[int, int]]:
        self.encoded += sum(map(len, pieces))
        of = self._codec.pieces
        return [(len(p), len(of[p]) // 4) for p in pieces]

    def boundary_before(self, place: int) -> int:
        """The last boundary between pieces at or before a place."""
        node, start = self._root, 0
        while node.leaves is None:
            for child in node.children:
                if start + child.chars > place or child is node.children[-1]:
                    node = child
                    break
                start += child.chars
        for chars, _ in node.leaves:
            if start + chars > place:
                break
            start += chars
        return start

    def edit(self, place: int, length: int, new: str) -> None:
        """Replace `length` characters at `place` by `new`."""
        place = min(max(place, 0), len(self.text))
        length = min(max(length, 0), len(self.text) - place)
        if not length and not new:
            return
        old_end, shift = place + length, len(new) - length
        self.text = self.text[:place] + new + self.text[old_end:]
        start = self.boundary_before(place - CONTEXT) if place > CONTEXT else 0
        pieces, at, meets = [], start, None
        for piece, end in self._pieces_from(start):
            # A boundary after the new text that was one in the old text.
            if at >= place + len(new) and self.boundary_before(at - shift) == at - shift:
                meets = at - shift
                break
            pieces.append(piece)
            at = end
        if meets is None:
            meets = len(self.text) - shift
        self._replace(self._root, 0, start, meets, self._counted(pieces))

    def _pieces_from(self, start: int):
        """(piece, its end) from a boundary on, split bit by bit; a piece at the end of a bit may
        be cut short, and is split again with more of the text."""
        stride = STRIDE
        while start < len(self.text):
            part = self.text[start : start + stride]
            pieces = self._codec.split(part)
            if start + stride < len(self.text):
                sure = sum(map(len, pieces))
                while pieces and sure > len(part) - CONTEXT:
                    sure -= len(pieces.pop())
            if not pieces:
                stride *= 2
                continue
            for piece in pieces:
                start += len(piece)
                yield piece, start

    def _replace(self, node: Node, offset: int, lo: int, hi: int, new: list[tuple[int, int]]) -> bool:
        """Put `new` in place of the pieces from lo to hi, both boundaries; says whether it was placed."""
        placed = False
        if node.leaves is not None:
            kept, at, where = [], offset, None
            for leaf in node.leaves:
                if at >= lo and where is None:
                    where = len(kept)
                if at < lo or at >= hi:
                    kept.append(leaf)
                at += leaf[0]
            where = len(kept) if where is None else where
            kept[where:where] = new
            placed = True
            if len(kept) > 4 * FAN:
                node.children, node.leaves = [build(kept)], None
            else:
                node.leaves = kept
        else:
            for i, child in enumerate(node.children):
                end = offset + child.chars
                last = i == len(node.children) - 1
                if (offset <= lo and (lo < end or last) and not placed) or (offset < hi and end > lo):
                    placed = self._replace(child, offset, lo, hi, [] if placed else new) or placed
                offset = end
        node.add_up()
        return placed


class TokenCounts:
    """Counts before and after edits, by a tokenizer file."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, "rb") as file:
            self._source = spark.sparkContext.broadcast(file.read())

    def after_edits(self, text: Column, edits: Column) -> Column:
        """struct<n_before, n_after, encoded, text>: tokens before and after the edits, an
        array<struct<place int, length int, new string>>; how many characters the
        edits made the encoder read; the edited text."""
        source = self._source

        @F.arrow_udf(returnType="struct<n_before:bigint,n_after:bigint,encoded:bigint,text:string>")
        def counted(texts: pa.Array, changes: pa.Array) -> pa.Array:
            of, rows = codec(source.value), []
            for text, edits_of in zip(texts, changes):
                one = CountedText(of, text.as_py() or "")
                before, read = one.n_tokens, one.encoded
                for edit in edits_of.as_py() or []:
                    if edit:
                        one.edit(edit["place"] or 0, edit["length"] or 0, edit["new"] or "")
                rows.append((before, one.n_tokens, one.encoded - read, one.text))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["n_before", "n_after", "encoded", "text"])

        return counted(text, edits)
