"""Importance resampling towards a target corpus, on hashed n-grams.

Words and word pairs of a text fall into a fixed number of buckets. A bucket's gain is the
logarithm of how much likelier the target corpus is to fill it than the raw one; a
document weighs the mean gain of its features, and a draw without replacement by Gumbel
keys takes the highest sums of weight and noise.

Texts go through Arrow kernels a few megabytes at a time: lower-cased, split, flattened and
encoded as dictionary indices. A pair of words is an index shifted beside the next one, so that only
distinct words and distinct pairs are hashed, and positions take their buckets from those.
Buckets of a document are written once and read for the counts and for the weights. Counts
leave a task as one row a bucket; the driver sees the table of buckets, whose size is a
parameter. The draw ranks narrow rows by a range shuffle, without a task that sees all.

Defined results: a null text has no words; a document without features weighs 0; a null id
draws like an empty string and comes before all others among ties; rows with one id are each ranked; an
empty table gives an empty result, an empty target or raw corpus has all counts 0; only the
named columns are read, others may have any names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.worker import portions, travels
from pagemill.operators.split import numbered
from pagemill.session import materialize

travels(__name__)

#: What stands between words: ASCII but for digits and lower-case letters, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SCALE = 1000
_FEATURES = "id bigint, n_words bigint, n_features bigint, buckets binary"


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words on end, as indices of the distinct ones, and where each text's words end."""
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern_regex(low, pattern=BETWEEN)
    flat = pc.list_flatten(lists)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(real)])
    ends = upto[np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))] if len(texts) else upto[:0]
    return flat.filter(pa.array(real)).dictionary_encode(), ends.astype(np.int64)


def buckets_of(words: pa.DictionaryArray, ends: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features on end, a word before the pair it begins, and where each text's end."""
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = words.dictionary.cast(pa.binary()).to_pylist()
    crc = [zlib.crc32(w) for w in known]
    pairs, place = np.unique(index[:-1] << 32 | index[1:], return_inverse=True)
    # A checksum goes on from where the first word's ended.
    after = [b" " + w for w in known]
    of_pairs = [zlib.crc32(after[b], crc[a]) for a, b in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist())]
    both = np.zeros((len(index), 2), np.int64)
    both[:, 0] = (np.array(crc, np.int64) % buckets).take(index)
    both[:-1, 1] = (np.array(of_pairs, np.int64) % buckets).take(place)
    # No pair reaches from one text into the next.
    real = np.ones((len(index), 2), bool)
    real[ends[ends > 0] - 1, 1] = False
    starts = np.concatenate([[0], ends[:-1]])
    return both[real], 2 * ends - np.cumsum(ends > starts)


def features(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, buckets): each row's features as packed bucket numbers."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                words, ends = words_of(part["text"])
                flat, upto = buckets_of(words, ends, buckets)
                data, edges = flat.astype(width).tobytes(), np.concatenate([[0], upto]) * int(width[2])
                packed = [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                columns = [part["id"], pa.array(np.diff(ends, prepend=0)), pa.array(np.diff(upto, prepend=0)), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(bucketed, _FEATURES)


def _unpacked(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all rows on end, and how many each row has."""
    held = [v.as_buffer() for v in column]
    sizes = np.array([len(b) for b in held], np.int64) // int(width[2])
    return np.frombuffer(b"".join(held), width), sizes


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket. A task hands on one row a bucket."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch["buckets"], width)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():  # `buckets` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled log ratios of the smoothed shares of each bucket, floored."""
    size, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)) for s, t in zip(raw.tolist(), target.tolist())]
    return np.array([math.floor(scale * math.log(r)) for r in ratio], np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of each row's features."""
    width = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _unpacked(batch["buckets"], width)
            upto = np.concatenate([[0], np.cumsum(gain.take(flat))])
            ends = np.cumsum(sizes)
            weight = (upto[ends] - upto[ends - sizes]) // np.maximum(sizes, 1)
            columns = [batch["id"], batch["n_words"], batch["n_features"], pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    return found.mapInArrow(weighed, "id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int, scale: int = SCALE) -> Column:
    """bigint: scaled Gumbel noise that depends on the seed and the row's id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-float(scale) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id: str = "item_id",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of `docs`; `rank` counts those
    drawn from 1 and is null for the others. Drawn are `percent` percent, rounded down, of the
    rows with `least_words` words, by highest score, ties to smaller ids."""
    found = materialize(features(docs, id_col, text_col, buckets), "features")
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(target, target_id, text_col, buckets), buckets))
    scored = weigh(found, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = materialize(scored, "scored")
    eligible = F.col("n_words") >= least_words
    wanted = scored.filter(eligible).count() * percent // 100
    placed = numbered(scored.filter(eligible).withColumn("_down", -F.col("score")), "_place", "_down", "id")
    rank = F.when(F.col("_place") < wanted, F.col("_place") + 1).cast("bigint")
    columns = ["id", "n_words", "n_features", "weight", "score"]
    ranked = placed.select(*columns, rank.alias("rank"))
    return ranked.unionByName(scored.filter(~eligible).select(*columns, F.lit(None).cast("bigint").alias("rank")))
