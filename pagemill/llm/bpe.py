"""Byte-level BPE encoding and decoding, exact and in linear time.

Encoding backtracks over the longest vocabulary entries that start at each position. An
Aho-Corasick pass finds those. A candidate is taken if it is compatible with the token
before it, that is, if the merges alone would leave the boundary between the two; if not,
the next shorter entry is tried, and if none is left the token before is reconsidered.
Every position is given up once at most, so the work is linear in the text. Decoding
gathers bytes from one blob through a table of offsets and needs no other table.

Defined results: null text is treated as empty, a null list as no ids; null and unknown ids are
left out; an empty table gives an empty result, repeated rows give equal ones. Text is read whole, whatever its length. The column functions
touch no other column; `transcode` replaces kept columns named like its results.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.worker import beside, portions, process_cache, travels

travels(__name__)

# Fixed value: the pattern of byte-level pre-tokenizers, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of a cache of encoded pieces (a worker has two) and of the table of compatible pairs that
#: is kept, and the longest piece kept. Speed only, never results.
CACHED_BYTES = 24 << 20
CACHED_PAIR_BYTES = 16 << 20
CACHED_LENGTH = 48
#: What an entry takes beside its content: two objects and a place in the dict.
_ENTRY, _PAIR = 230, 140
#: Ids whose bytes are gathered at a time.
GATHERED = 1 << 16
#: Bytes of text that `transcode` holds at a time, with their ids.
HELD = 1 << 21
#: Pieces up to this many bytes look longest entries up where needed, longer ones all in one pass.
SHORT_PIECE = 64
# The same pattern for text of ASCII and Latin-1 letters alone, where all classes are short lists;
# the standard library's engine is quicker at it.
_LATIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*+")
_LATIN_PATTERN = re.compile(
    r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]++| ?[0-9]++| ?[^\s0-9A-Za-zÀ-ÖØ-öø-ÿ]++|\s+(?!\S)|\s+"
)


def _alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable Latin-1, else the next code from 256."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    table = {chr(b): b for b in printable}
    rest = [b for b in range(256) if chr(b) not in table]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces(dict):
    """piece -> its ids as packed 32-bit numbers, filled on demand.

    A full cache becomes the old one; pieces still in use return from there.
    """

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode, self._old, self._held = encode, {}, 0

    def __missing__(self, piece: str) -> bytes:
        packed = self._old.get(piece)
        if packed is None:
            packed = array("i", self._encode(piece)).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if self._held >= CACHED_BYTES:
                self._old, self._held = dict(self), 0
                self.clear()
            self[piece] = packed
            self._held += _ENTRY + len(piece) + len(packed)
        return packed


def _entries(spec: dict) -> tuple[dict[bytes, int], dict[str, int]]:
    """id of the bytes of each vocabulary entry, and of each added token."""
    alphabet = _alphabet()
    vocab = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    return vocab, {t["content"]: t["id"] for t in spec.get("added_tokens") or []}


class Decoder:
    """The bytes of all tokens on end, and where each begins; an id outside the vocabulary has none."""

    def __init__(self, vocab: dict[bytes, int], added: dict[str, int]) -> None:
        table: list[bytes] = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            table[i] = token
        for token, i in added.items():
            table[i] = token.encode()
        self.blob = np.frombuffer(b"".join(table), np.uint8)
        self.offset = np.cumsum([0, *map(len, table)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; unknown ids are left out, broken UTF-8 is replaced."""
        return b"".join(self._gather(ids[at : at + GATHERED]) for at in range(0, len(ids), GATHERED)).decode("utf-8", "replace")

    def _gather(self, ids: np.ndarray) -> bytes:
        if ids.min() < 0 or ids.max() >= len(self.offset) - 1:
            ids = ids[(ids >= 0) & (ids < len(self.offset) - 1)]
        begin = self.offset[ids]
        size = self.offset[ids + 1] - begin
        upto = np.cumsum(size)
        return self.blob[np.repeat(begin - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)].tobytes()


class BytePairCodec:
    """Encoder and decoder of one tokenizer file (JSON, byte-level BPE without a normalizer)."""

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (
            model.get("type", "BPE") != "BPE"
            or spec.get("normalizer")
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        ):
            raise ValueError("only plain byte-level BPE is supported")
        added = spec.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take blanks are not supported")
        vocab, self._added = _entries(spec)
        # The leftmost, then longest added token counts.
        names = sorted(self._added, key=len, reverse=True)
        self._split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._pattern = regex.compile(PATTERN)

        self.decode = Decoder(vocab, self._added).decode
        self._link(vocab, [tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]])
        self.pieces = Pieces(self.encode_piece)

    def _link(self, vocab: dict[bytes, int], merges: list) -> None:
        """Tables of merges, of the pairs known to be compatible, of prefixes; the automaton."""
        alphabet, size = _alphabet(), 1 + max([*vocab.values(), *self._added.values()])
        self._rank, self._left, self._right, self._merge = {}, {}, {}, {}
        for byte in range(256):
            self._rank[vocab[bytes([byte])]] = -1
        for rank, (left, right) in enumerate(merges):
            a, b = (bytes(alphabet[c] for c in half) for half in (left, right))
            whole = vocab[a + b]
            self._merge[vocab[a], vocab[b]] = rank
            if whole not in self._rank:
                self._rank[whole], self._left[whole], self._right[whole] = rank, vocab[a], vocab[b]
        self._pairs: dict[int, bool] = {}
        # Entries that merges never produce from their own bytes cannot occur in a result.
        made: set[int] = set()
        for token, rank in sorted(self._rank.items(), key=lambda item: item[1]):
            a, b = self._left.get(token), self._right.get(token)
            if rank < 0 or (a in made and b in made and self._stays_apart(a, b, rank)):
                made.add(token)
        self._of = {token.decode("latin-1"): i for token, i in vocab.items() if i in made}
        # By id: bytes of an entry, and the longest entry it starts with.
        self._length = [0] * size
        self._shorter: list[int | None] = [None] * size
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in self._of.items():
            self._length[i] = len(token)
            self._automaton.add_word(token, i)
            for end in range(len(token) - 1, 0, -1):
                if (shorter := self._of.get(token[:end])) is not None:
                    self._shorter[i] = shorter
                    break
        self._automaton.make_automaton()

    def _stays_apart(self, a: int, b: int, limit: float) -> bool:
        """Whether no merge of rank below `limit` joins the boundary between tokens a and b.

        Merges are undone from the latest back. Across the boundary only the last part of
        a and the first part of b can meet; had they a merge that comes before the one
        just undone, it would have happened instead. Of equal merges the left one is first.
        """
        rank, merge = self._rank, self._merge
        while True:
            if merge.get((a, b), limit) < limit:
                return False
            if rank[a] > rank[b]:
                limit = min(limit, rank[a])
                a = self._right[a]
            elif rank[b] >= 0:
                limit = min(limit, rank[b] + 1)
                b = self._left[b]
            else:
                return True

    def _compatible(self, a: int, b: int) -> bool:
        """The table of compatible pairs, filled on demand."""
        if len(self._pairs) * _PAIR >= CACHED_PAIR_BYTES:
            self._pairs.clear()
        known = self._pairs[a << 32 | b] = self._stays_apart(a, b, float("inf"))
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one piece of the pre-tokenizer."""
        data = piece if piece.isascii() else piece.encode("utf-8", "surrogatepass").decode("latin-1")
        if (whole := self._of.get(data)) is not None:
            return [whole]
        size, length, shorter = len(data), self._length, self._shorter
        entry, prefix, known = self._of.get, self._automaton.longest_prefix, self._pairs.get
        longest = self._longest_everywhere(data) if size > SHORT_PIECE else None
        tokens: list[int] = []
        dead: set[int] = set()  # positions given up
        at, before, token = 0, -1, None
        while True:
            if token is None and longest:
                token = longest[at]
            elif token is None:
                rest = data[at:]
                rest = rest[: prefix(rest)]
                while (token := entry(rest)) is None:
                    rest = rest[:-1]
            fits = before < 0 or known(before << 32 | token)
            if fits is None:
                fits = self._compatible(before, token)
            if fits:
                end = at + length[token]
                if end not in dead:
                    tokens.append(token)
                    if end == size:
                        return tokens
                    at, before, token = end, token, None
                    continue
            token = shorter[token]
            while token is None:  # nothing else starts here: the token before is tried shorter
                dead.add(at)
                token = tokens.pop()
                at -= length[token]
                before = tokens[-1] if tokens else -1
                token = shorter[token]

    def _longest_everywhere(self, data: str) -> list[int]:
        """The longest entry that starts at each position."""
        found = [0] * len(data)
        for end, token in self._automaton.iter(data):  # a longer match ends later and replaces
            found[end + 1 - self._length[token]] = token
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of ordinary text."""
        return (_LATIN_PATTERN if _LATIN.fullmatch(text) else self._pattern).findall(text)

    def _pack(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit numbers."""
        if not text:
            return b""
        if self._split is None or not any(name in text for name in self._added):
            return self._pack(text)
        parts = self._split.split(text)
        return b"".join(
            array("i", [self._added[part]]).tobytes() if i % 2 else self._pack(part) for i, part in enumerate(parts)
        )

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()


def codec(source: bytes) -> BytePairCodec:
    """The worker's codec for a tokenizer file, built once per process."""
    key = "bpe", hashlib.sha256(source).hexdigest()
    cache = process_cache()
    if key not in cache:
        cache[key] = BytePairCodec(source)
    return cache[key]


def decoder(source: bytes) -> Decoder:
    """The worker's decoder for a tokenizer file, without the tables that only encoding needs."""
    key = "bpe-decoder", hashlib.sha256(source).hexdigest()
    cache = process_cache()
    if key not in cache:
        cache[key] = Decoder(*_entries(json.loads(source)))
    return cache[key]


class Bpe:
    """Column functions of a tokenizer file. The file (a vocabulary, a few MB) is broadcast."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, "rb") as file:
            self._source = spark.sparkContext.broadcast(file.read())

    def encode(self, text: Column) -> Column:
        """array<int>: the ids of the whole text, without added start or end tokens.

        Declared nondeterministic, or Spark would encode once more inside a decode of the ids.
        """
        source = self._source

        @F.arrow_udf(returnType="array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            of = codec(source.value).packed
            return _lists([of(text.as_py()) for text in texts])

        return encode.asNondeterministic()(text)

    def decode(self, ids: Column) -> Column:
        """string: the text of array<int>, special tokens included."""
        source = self._source

        @F.arrow_udf(returnType="string")
        def decode(lists: pa.Array) -> pa.Array:
            of = decoder(source.value).decode
            return pa.array([of(ids) for ids in _numbers(lists)], pa.string())

        return decode(ids)

    def transcode(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """The kept columns of `docs` (all by default), `ids`, and the text `decoded` from them.

        One worker of a task does both, and a few megabytes of text and ids at a time.
        """
        source = self._source
        kept = beside(docs.columns if keep is None else keep, ["ids", "decoded", "_text"])
        rows = docs.select(*kept, F.col(text_col).alias("_text"))

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of = codec(source.value)
            for batch in batches:
                for part in portions(batch, "_text", HELD):
                    lists = _lists([of.packed(text.as_py()) for text in part["_text"]])
                    decoded = pa.array([of.decode(ids) for ids in _numbers(lists)], pa.string())
                    yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), lists, decoded], [*kept, "ids", "decoded"])

        return rows.mapInArrow(coded, rows.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string"))


def _lists(packed: list[bytes]) -> pa.ListArray:
    """Lists of the ids that are packed as 32-bit numbers."""
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _numbers(lists: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each list that are not null; none for a null list."""
    if lists.values.null_count:
        for one in lists:
            yield one.values.drop_null().to_numpy() if one.is_valid else np.empty(0, np.int32)
        return
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    for known, a, b in zip(lists.is_valid().to_numpy(zero_copy_only=False), ends, ends[1:]):
        yield flat[a:b] if known else flat[:0]
