"""Interpolated modified Kneser-Ney model of word pairs, for perplexity over a large corpus.

Spark counts words, then pairs of a word and the one before it; the end of a text is a word too, and
also what its first word follows. Both tables are kept as sorted arrays of hashes in the shared
folder, cut into files of bounded size that each task writes for itself, and workers map
them into memory: only the pages that a batch asks for are read, and none of it passes the driver.

- Words: sorted 64-bit hashes, cut by their top bits. A word's id is its file and its place
  there; beside the hashes stand its count, the counts before it, and its number of
  distinct predecessors.
- Pairs: keys (first word, second word) in order, with counts. They are cut into ranges of
  SHARE running words by the first word's counts. A word that alone has more is cut by the
  second one, so a hot word is spread over as many tasks as it needs. Tasks count pairs before the
  shuffle and send them as packed, sorted runs.

With c(v, w) the count of a pair, t(w) the distinct predecessors of w and B all distinct pairs:

    p(w | v) = max(c(v, w) - D, 0) / c(v) + g(v) p(w)     p(w) = max(t(w) - d, 0) / B + g / (V + 1)

where D depends on c(v, w) being 1, 2 or more, d likewise on t(w), both from the counts of
counts, and g(v), g are what the discounts set free. After a word never seen p(w) holds, and
a word never seen takes the share of the one unknown word.

Defined results: a null text is an empty one, and an empty text is its end alone; without
training texts every word has probability 1 (only the unknown word is known); an empty table gives an empty result;
repeated rows teach and are scored as often as they stand there; result columns replace kept columns of
the same name. Words that agree in their 64-bit hash would count as one. The shared folder
(spark.checkpoint.dir) must be mounted on every machine, or its files could not be mapped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.worker import beside, portions, process_cache, travels
from pagemill.session import materialize, scratch_path

travels(__name__)

#: Words of a file of the word table, about; running words behind a file of the pair table;
#: running words that a task counts before it hands pairs on.
WORDS_A_FILE = 1 << 20
SHARE = 1 << 21
AT_ONCE = 1 << 22
#: Discounts where a table is too small to have all counts of counts.
FALLBACK = (0.5, 1.0, 1.5)
#: Bits of a word id within a key.
_ID_BITS = 40
#: The hash of the end of a text; no word holds a line break.
END = np.uint64(xxhash.xxh64_intdigest(b"\n")).astype(np.int64)
SCORED = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that all machines can map files from."""
    place = urlparse(scratch_path(spark, label))
    if place.scheme not in ("", "file"):
        raise ValueError("model files are memory-mapped: spark.checkpoint.dir must be a mounted folder")
    os.makedirs(place.path, exist_ok=True)
    return place.path


def _save(path: str, values: np.ndarray) -> None:
    """Whole or not at all. What a task writes follows from its input alone, so that a
    repeated task puts the same file in place."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as file:
        np.save(file, values)
    os.replace(part, path)


def _mapped(path: str) -> np.ndarray:
    """The array of a file, mapped once per worker process."""
    cache = process_cache()
    if (path := f"{path}.npy") not in cache:
        cache[path] = np.load(path, mmap_mode="r")
    return cache[path]


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words and, last, of the end; running words as places among them; words of each text)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = pc.list_flatten(lists)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(real)])
    ends = upto[np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))] if len(texts) else upto[:0]
    words = flat.filter(pa.array(real)).dictionary_encode()
    hashed = xxhash.xxh64_intdigest
    keys = np.array([hashed(w) for w in words.dictionary.cast(pa.binary()).to_pylist()], np.uint64).astype(np.int64)
    return np.append(keys, END), words.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(ends, prepend=0)


def running(index: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The words of all texts on end, the end before the first and after each."""
    out = np.full(len(index) + len(sizes) + 1, end, np.int64)
    out[1 + np.arange(len(index)) + np.repeat(np.arange(len(sizes)), sizes)] = index
    return out


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])


@dataclass
class Words:
    """The word table: 2 ** `bits` files, whose words and running words are known; ids have `width` bits for the place."""

    folder: str
    bits: int
    width: int
    sizes: np.ndarray
    before: np.ndarray

    def _file(self, name: str, number: int) -> np.ndarray:
        return _mapped(f"{self.folder}/words-{number:06d}.{name}")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids of hashes, -1 for those unknown."""
        out = np.full(len(keys), -1, np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        files = (keys >> (64 - self.bits)) + (1 << self.bits >> 1) if self.bits else np.zeros(len(keys), np.int64)
        for begin, end in _spans(files):
            number = int(files[begin])
            if not self.sizes[number]:
                continue
            known = self._file("key", number)
            place = np.minimum(np.searchsorted(known, keys[begin:end]), len(known) - 1)
            hit = known[place] == keys[begin:end]
            out[order[begin:end][hit]] = number << self.width | place[hit]
        return out

    def take(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of a column for ids in ascending order."""
        out = np.zeros(len(ids), np.int64)
        files = ids >> self.width
        for begin, end in _spans(files):
            out[begin:end] = self._file(name, int(files[begin]))[ids[begin:end] & ((1 << self.width) - 1)]
        return out

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """Running words of all words before each of the ids, which are in ascending order."""
        return self.take("upto", ids) + self.before[ids >> self.width]

    def shares(self, starts: np.ndarray, counts: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The pair file of pairs whose first word has these starts and counts. It does not fall
        as pairs ascend: a first word's range is dealt out by the id of the second."""
        part = second / float(len(self.sizes) << self.width)
        return (starts + np.minimum((counts * part).astype(np.int64), counts - 1)) // SHARE


def _spans(sorted_values: np.ndarray) -> Iterable[tuple[int, int]]:
    at = runs(sorted_values).tolist()
    return zip(at, [*at[1:], len(sorted_values)])


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from portions(batch, "text")


def count_words(texts: DataFrame) -> DataFrame:
    """(key, n): hash and count of every word of the column `text`, the end included."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _text_batches(batches):
            keys, index, sizes = tokens(part["text"])
            n = np.bincount(index, minlength=len(keys))
            n[-1] = len(sizes)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64())], ["key", "n"])

    return texts.mapInArrow(counted, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def write_words(counts: DataFrame, folder: str, distinct: int) -> Words:
    """Store the word table, `distinct` words, each file by a task of its own."""
    bits = max(0, (distinct - 1) // WORDS_A_FILE).bit_length()
    number = (F.shiftright("key", 64 - bits) + (1 << bits >> 1)) if bits else F.lit(0).cast("bigint")

    def stored(table: pa.Table) -> pa.Table:
        number, keys, n = table["file"][0].as_py(), table["key"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        for name, values in (("key", keys), ("count", n), ("upto", np.cumsum(n) - n)):
            _save(f"{folder}/words-{number:06d}.{name}.npy", values)
        return pa.table({"file": [number], "size": [len(keys)], "total": [int(n.sum())]})

    rows = counts.withColumn("file", number).groupBy("file").applyInArrow(stored, "file bigint, size bigint, total bigint")
    sizes, totals = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    for row in rows.collect():  # a row for each file
        sizes[row["file"]], totals[row["file"]] = row["size"], row["total"]
    return Words(folder, bits, int(sizes.max()).bit_length(), sizes, np.cumsum(totals) - totals)


_PACKED = "share bigint, first bigint, size bigint, gaps binary, second binary, n binary"


def count_pairs(texts: DataFrame, words: Words) -> DataFrame:
    """Packed runs of pairs in order, with counts, one row a pair file and AT_ONCE running words."""

    def packed(sequences: list[np.ndarray]) -> pa.RecordBatch:
        ids, place = np.unique(np.concatenate(sequences), return_inverse=True)
        # Places among the ids are in their order; no pair reaches from one sequence into the next.
        pairs = place[:-1] << 32 | place[1:]
        pairs = np.delete(pairs, np.cumsum([len(s) for s in sequences])[:-1] - 1)
        pairs.sort()
        at = runs(pairs)
        pairs, n = pairs[at], np.diff(at, append=len(pairs))
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        first, second = ids[a], ids[b]
        share = words.shares(words.starts(ids)[a], words.take("count", ids)[a], second)
        rows = []
        for begin, end in _spans(share):
            gaps = np.diff(first[begin:end], prepend=first[begin])
            columns = [_narrow(c).tobytes() for c in (gaps, second[begin:end], n[begin:end])]
            rows.append((int(share[begin]), int(first[begin]), end - begin, *columns))
        names = ["share", "first", "size", "gaps", "second", "n"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in _text_batches(batches):
            keys, index, sizes = tokens(part["text"])
            held.append(running(words.find(keys)[index], sizes, int(words.find(END[None])[0])))
            if sum(map(len, held)) >= AT_ONCE:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return texts.mapInArrow(counted, _PACKED)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // size}").astype(np.int64)


#: Kinds of what a pair file tells: distinct predecessors of a word id, pairs by count (1 to 4), pairs of a file.
PREDECESSORS, OF_COUNT, PAIRS = 0, 1, 2


def write_pairs(packed: DataFrame, folder: str) -> DataFrame:
    """Store the pair table, each file by a task of its own; (kind, id, n) of its contents."""

    def stored(table: pa.Table) -> pa.Table:
        share = table["share"][0].as_py()
        columns = []
        for row in table.to_batches():
            for first, size, gaps, second, n in zip(*(row[c] for c in ("first", "size", "gaps", "second", "n"))):
                size = size.as_py()
                known = [_unpacked(c.as_py(), size) for c in (gaps, second, n)]
                known[0] = first.as_py() + np.cumsum(known[0])
                columns.append(known)
        first, second, n = map(np.concatenate, zip(*columns))
        least = int(first.min())
        keys = first - least << _ID_BITS | second
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        at = runs(keys)
        keys, n = keys[at], np.add.reduceat(n, at)
        local = keys >> _ID_BITS
        # By first word: pairs seen once, twice, more often.
        seen = np.stack([np.bincount(local[some], minlength=local[-1] + 1) for some in (n == 1, n == 2, n > 2)])
        path = f"{folder}/pairs-{share:09d}"
        for name, values in (("key", keys), ("count", _narrow(n)), ("seen", _narrow(seen)), ("first", np.array([least]))):
            _save(f"{path}.{name}.npy", values)
        after = np.sort(keys & ((1 << _ID_BITS) - 1))
        at = runs(after)
        ids = np.concatenate([after[at], np.arange(1, 5), [share]])
        counts = np.concatenate([np.diff(at, append=len(after)), np.bincount(n[n < 5], minlength=5)[1:5], [len(keys)]])
        kinds = np.repeat([PREDECESSORS, OF_COUNT, PAIRS], [len(at), 4, 1])
        return pa.table({"kind": pa.array(kinds, pa.int32()), "id": pa.array(ids, pa.int64()), "n": pa.array(counts, pa.int64())})

    told = packed.groupBy("share").applyInArrow(stored, "kind int, id bigint, n bigint")
    return told.groupBy("kind", "id").agg(F.sum("n").alias("n"))


def write_predecessors(told: DataFrame, words: Words) -> None:
    """Store the distinct predecessors of each word beside it. Every word has some."""

    def stored(table: pa.Table) -> pa.Table:
        number, ids, n = table["file"][0].as_py(), table["id"].to_numpy(), table["n"].to_numpy()
        _save(f"{words.folder}/words-{number:06d}.after.npy", _narrow(n[np.argsort(ids)]))
        return pa.table({"file": [number], "size": [len(ids)]})

    rows = told.filter(F.col("kind") == PREDECESSORS).withColumn("file", F.shiftright("id", words.width))
    for row in rows.groupBy("file").applyInArrow(stored, "file bigint, size bigint").collect():  # a row for each file
        if row["size"] != words.sizes[row["file"]]:
            raise RuntimeError("the word and pair tables disagree: did the training rows change between two reads?")


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and more, from the numbers of counts 1 to 4."""
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, *FALLBACK])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.0), float(i + 1)) for i, d in enumerate(raw))])


@dataclass
class KneserNey:
    """A fitted model: where its files are, totals, discounts. A few numbers a file."""

    words: Words | None
    tokens: int
    distinct: int
    shares: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    pairs: int = 0
    discount: np.ndarray = field(default_factory=lambda: np.zeros(4))
    lower: np.ndarray = field(default_factory=lambda: np.zeros(4))
    free: float = 1.0

    def _word(self, after: np.ndarray) -> np.ndarray:
        """p(w) by the number of distinct predecessors."""
        kept = np.maximum(after - self.lower[np.minimum(after, 3)], 0) / max(self.pairs, 1)
        return kept + self.free / (self.distinct + 1)

    def _pairs(self, share: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of pairs in ascending order."""
        out = np.zeros(len(first), np.int64)
        for begin, end in _spans(share):
            if not self._has(int(share[begin])):
                continue
            path = f"{self.words.folder}/pairs-{share[begin]:09d}"
            keys, least = _mapped(f"{path}.key"), int(_mapped(f"{path}.first")[0])
            local = first[begin:end] - least
            asked = np.where(local >= 0, local << _ID_BITS | second[begin:end], -1)
            place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            out[begin:end] = np.where(keys[place] == asked, _mapped(f"{path}.count")[place], 0)
        return out

    def _has(self, share: int) -> bool:
        at = np.searchsorted(self.shares, share)
        return at < len(self.shares) and self.shares[at] == share

    def _free(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """g(v) of words in ascending order. A word's pairs may lie in several files."""
        seen = np.zeros((3, len(ids)), np.int64)
        lo, hi = starts // SHARE, (starts + counts - 1) // SHARE
        here = self.shares[(self.shares >= lo.min(initial=0)) & (self.shares <= hi.max(initial=-1))]
        for share in here.tolist():
            begin, end = int(np.searchsorted(hi, share)), int(np.searchsorted(lo, share, "right"))
            if begin >= end:
                continue
            path = f"{self.words.folder}/pairs-{share:09d}"
            table, local = _mapped(f"{path}.seen"), ids[begin:end] - int(_mapped(f"{path}.first")[0])
            inside = (local >= 0) & (local < table.shape[1])
            seen[:, begin:end][:, inside] += table[:, local[inside]]
        return (self.discount[1:, None] * seen).sum(0) / np.maximum(counts, 1)

    def score(self, texts: pa.Array) -> list[np.ndarray]:
        """(n_tokens, n_known, base_score, score) of every text."""
        keys, index, sizes = tokens(texts)
        ids = self.words.find(keys) if self.words else np.full(len(keys), -1, np.int64)
        # Words in the order of their ids, so that pairs are asked for in the order they are stored in.
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids, unknown = ids[order], int((ids < 0).sum())
        count, after, starts, free = (np.zeros(len(ids), t) for t in (np.int64, np.int64, np.int64, np.float64))
        if unknown < len(ids):
            known = ids[unknown:]
            count[unknown:], after[unknown:] = self.words.take("count", known), self.words.take("after", known)
            starts[unknown:] = self.words.starts(known)
            free[unknown:] = self._free(known, starts[unknown:], count[unknown:])
        lower = self._word(after)

        line = rank[running(index, sizes, len(keys) - 1)]
        pairs, place = np.unique(line[:-1] << 32 | line[1:], return_inverse=True)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        p = lower[b]
        told = np.flatnonzero(a >= unknown)  # pairs whose first word is known
        both = told[b[told] >= unknown]
        n = np.zeros(len(pairs), np.int64)
        if len(both):
            va, vb = a[both], b[both]
            n[both] = self._pairs(self.words.shares(starts[va], count[va], ids[vb]), ids[va], ids[vb])
        at, m = a[told], n[told]
        p[told] = np.maximum(m - self.discount[np.minimum(m, 3)], 0) / np.maximum(count[at], 1) + free[at] * lower[b[told]]

        base = np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        sums = lambda values: np.add.reduceat(values, begin) if len(begin) else values[:0]
        return [sizes + 1, sums((count > 0)[line[1:]].astype(np.int64)), sums(base[line[1:]]), sums(np.log10(p)[place])]


def fit(docs: DataFrame, text_col: str = "text") -> KneserNey:
    """The model of all rows of `docs`."""
    texts = docs.select(F.col(text_col).alias("text"))
    counts = materialize(count_words(texts), "word-counts")
    found = counts.filter("n > 0").agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("tokens")).first()
    if not found["distinct"]:
        return KneserNey(None, 0, 0)
    words = write_words(counts.filter("n > 0"), shared_folder(docs.sparkSession, "ngrams"), found["distinct"])
    told = materialize(write_pairs(count_pairs(texts, words), words.folder), "pairs-told")
    write_predecessors(told, words)
    # A row for each file of pairs, and four.
    listed = {(r["kind"], r["id"]): r["n"] for r in told.filter(F.col("kind") != PREDECESSORS).collect()}
    n = F.col("n")
    of = told.filter(F.col("kind") == PREDECESSORS).agg(
        F.sum(n).alias("all"), *[F.count_if(n == i).alias(f"n{i}") for i in range(1, 5)], F.count_if(n > 2).alias("more")
    ).first()
    lower = discounts(*(of[f"n{i}"] for i in range(1, 5)))
    return KneserNey(
        words=words,
        tokens=found["tokens"],
        distinct=found["distinct"],
        shares=np.array(sorted(i for kind, i in listed if kind == PAIRS), np.int64),
        pairs=of["all"],
        discount=discounts(*(listed[OF_COUNT, i] for i in range(1, 5))),
        lower=lower,
        free=float(lower[1] * of["n1"] + lower[2] * of["n2"] + lower[3] * of["more"]) / of["all"],
    )


def score(docs: DataFrame, model: KneserNey, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of `docs` (all but the text by default) with the number of words and ends of a text, those known to
    the model, the running words it learnt from, the log10 probability of the text by single
    words with half a count added, and by the model."""
    kept = beside([c for c in docs.columns if c != text_col] if keep is None else keep, [*SCORED, "text"])
    rows = docs.select(*kept, F.col(text_col).alias("text"))
    types = ("long", "long", "long", "double", "double")
    schema = rows.select(*kept).schema
    for name, kind in zip(SCORED, types):
        schema = schema.add(name, kind)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _text_batches(batches):
            size, known, base, own = model.score(part["text"])
            taught = np.full(len(part), model.tokens)
            columns = [pa.array(v) for v in (size, known, taught, base, own)]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), *columns], [*kept, *SCORED])

    return rows.mapInArrow(scored, schema)
