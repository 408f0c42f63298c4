"""Repeatable order and exact train/validation split.

Rows are ordered by md5(seed:key), so the order depends on the keys alone, not on files,
partitions or earlier steps. Hash prefixes serve as equal-sized buckets: their counts
(at most 16**4 rows, whatever the data) give each bucket's place in the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pagemill.session import materialize

PREFIX = 4  # hex digits of a bucket
HASH_DIGITS = 32  # hex digits of an md5
RANKED = 100_000  # most rows ranked by one task to find the cut
SPLIT_SEED = 42  # fixed values: seed and share of the validation part
VAL_RATIO = 0.1


def order_hash(key: Column, seed: int = SPLIT_SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key_text(key)))


def key_text(key: Column) -> Column:
    """A missing key counts as the empty one, as in the dedup."""
    return F.coalesce(key.cast("string"), F.lit(""))


def _bucket(digest: Column, digits: int = PREFIX) -> Column:
    return F.substring(digest, 1, digits)


def _bucket_counts(hashed: DataFrame, digits: int = PREFIX) -> DataFrame:
    """(bucket, n, upto, total); the windows run over at most 16**PREFIX counts, provided
    the rows agree in all but the last PREFIX of the bucket's digits."""
    return running_counts(hashed.groupBy(_bucket(F.col("_hash"), digits).alias("bucket")).agg(F.count(F.lit(1)).alias("n")))


def running_counts(counts: DataFrame) -> DataFrame:
    """(bucket, n, upto, total) of the counts of buckets."""
    return counts.select(
        "bucket",
        "n",
        F.sum("n").over(Window.orderBy("bucket")).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )


def row_digest(df: DataFrame) -> Column:
    """Tells rows with equal keys apart; rows it does not tell apart are equal throughout."""
    return F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def numbered(df: DataFrame, first: str, *order: str) -> DataFrame:
    """Rows with `first`, their place in the order of the columns `order`, from 0.

    Sorted into ranges and written; a place is the row's number in its partition and the
    rows of the partitions before it. The id comes last in the order, so that equal
    rows, however many, are spread over tasks too.
    """
    ranged = df.withColumn("_id", F.monotonically_increasing_id()).repartitionByRange(*order, "_id")
    rows = ranged.sortWithinPartitions(*order, "_id").drop("_id").select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_line")
    )
    rows = materialize(rows, "ordered")
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_line").alias("_from"))
    before = F.sum("n").over(Window.orderBy("_part")) - F.col("n")
    starts = counts.select("_part", "_from", before.alias("_start"))  # a row for each partition
    place = F.col("_start") + F.col("_line") - F.col("_from")
    return rows.join(F.broadcast(starts), "_part").withColumn(first, place).drop("_part", "_line", "_from", "_start")


def seeded_order(df: DataFrame, key: str, seed: int = SPLIT_SEED) -> DataFrame:
    """Add `position`, the row's exact place (from 0) in the seeded order.

    Rows with equal keys follow the digest of the whole row. The result is not sorted: its
    user sorts by `position`, or writes with `write_split`, which does.
    """
    hashed = df.withColumns({
        "_hash": order_hash(F.col(key), seed), "_key": key_text(F.col(key)), "_row": row_digest(df),
    })
    return numbered(hashed, "position", "_hash", "_key", "_row").drop("_hash", "_key", "_row")


def split_cut(df: DataFrame, key: str, val_ratio: float, seed: int) -> tuple[str, str, int, int] | None:
    """(hash, key, n, of) of the last training row's key in the seeded order: `n` of the `of`
    rows with that key belong to the training part. None if there is no training row.

    Only the keys are read from `df`, once, into a scratch table. Counts show which bucket
    holds the cut; that bucket is counted again by further digits until it is small, and
    only then ranked. No task ranks more than RANKED rows, however many there are.
    """
    keys = df.select(
        order_hash(F.col(key), seed).alias("_hash"), key_text(F.col(key)).alias("_key")
    )
    rows = materialize(keys, "split-keys")
    place = cut_bucket(_bucket_counts(rows), val_ratio)
    return place and cut_within(rows, place)


def cut_bucket(counts: DataFrame, val_ratio: float) -> Row | None:
    """The bucket of `_bucket_counts` with the last training row, which is its row number `wanted` - (`upto` - `n`)."""
    share = F.col("total").cast("double") * F.lit(1 - val_ratio)
    return counts.withColumn("wanted", F.floor(share).cast("long")).filter(_holds("wanted")).first()


def cut_within(rows: DataFrame, place: Row) -> tuple[str, str, int, int]:
    """The cut in a bucket, counted again by further digits until it is small, and only then ranked."""
    digits = PREFIX
    while True:
        wanted = place["wanted"] - (place["upto"] - place["n"])
        rows = rows.filter(F.startswith("_hash", F.lit(place["bucket"])))
        if place["n"] <= RANKED or digits == HASH_DIGITS:
            break
        digits += PREFIX
        place = _bucket_counts(rows, digits).withColumn("wanted", F.lit(wanted)).filter(_holds("wanted")).first()
    cut = (
        rows.groupBy("_hash", "_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(Window.orderBy("_hash", "_key")))
        .withColumn("wanted", F.lit(wanted))
        .filter(_holds("wanted"))
        .first()
    )
    return cut["_hash"], cut["_key"], wanted - (cut["upto"] - cut["n"]), cut["n"]


def _holds(position: str) -> Column:
    """The group of `n` rows that ends at `upto` contains the row with that number."""
    return (F.col("upto") >= F.col(position)) & (F.col("upto") - F.col("n") < F.col(position))


def train_val_split(
    df: DataFrame, key: str, val_ratio: float = VAL_RATIO, seed: int = SPLIT_SEED
) -> DataFrame:
    """Add `split`: the first int(n * (1 - val_ratio)) rows in seeded order are 'train', the
    rest 'val'. Exact, disjoint and complete.

    Finding the cut works on the key column alone; labelling the rows is then a plain
    comparison, so the wide rows are neither shuffled nor sorted; but if the cut falls
    between rows with equal keys, those rows are, by a digest of the whole row.
    """
    return label_split(df, key, split_cut(df, key, val_ratio, seed), seed)


def label_split(df: DataFrame, key: str, cut: tuple[str, str, int, int] | None, seed: int = SPLIT_SEED) -> DataFrame:
    """Add `split` by a cut: rows up to it in the seeded order are 'train', the rest 'val'."""
    if cut is None:
        return df.withColumn("split", F.lit("val"))
    digest, text = order_hash(F.col(key), seed), key_text(F.col(key))
    before = (digest < cut[0]) | ((digest == cut[0]) & (text < cut[1]))
    same = (digest == cut[0]) & (text == cut[1])
    name = lambda train: F.when(train, F.lit("train")).otherwise(F.lit("val"))
    if cut[2] == cut[3]:
        return df.withColumn("split", name(before | same))
    # The cut falls between rows with equal keys: they alone are put in order.
    rows = numbered(df.filter(same).withColumn("_row", row_digest(df)), "_place", "_row")
    rows = rows.withColumn("split", name(F.col("_place") < cut[2])).select(*df.columns, "split")
    return df.filter(~same).withColumn("split", name(before)).unionByName(rows)


def sample_pair(df: DataFrame, key: str, seed: int = SPLIT_SEED) -> DataFrame:
    """The first training row in seeded order, or the first validation row if there is none."""
    part = F.when(F.col("split") == "train", 0).otherwise(1)
    return df.orderBy(part, order_hash(F.col(key), seed), F.col(key)).limit(1)
