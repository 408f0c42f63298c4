"""An exact train/validation split of rows that keep arriving.

The split is by a cut in the seeded order (see `operators.split`), so a row's part follows from its key and the cut. The store
keeps the keys' hashes by their first digits, and a histogram of hash buckets that each batch adds to. An append finds
the new cut from the histogram and the keys of one bucket; only rows between the old and the new cut
change sides, and nothing is stored again for it. Batches and cuts come into force by versions (see `snapshots`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.operators.split import (
    SPLIT_SEED,
    VAL_RATIO,
    cut_bucket,
    cut_within,
    key_text,
    label_split,
    order_hash,
    running_counts,
)
from pagemill.sources.snapshots import Snapshots

FOLDER_DIGITS = 2  # hex digits of a hash that name its folder
BUCKET_DIGITS = 4
_KEYS = "_hash string, _key string"


class GrowingSplit:
    """Rows of one schema at `path`, split by `key`."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str = "url",
        val_ratio: float = VAL_RATIO, seed: int = SPLIT_SEED,
    ) -> None:
        self.spark, self.schema, self.key, self.val_ratio, self.seed = spark, schema, key, val_ratio, seed
        self.log = Snapshots(spark, path)

    def _state(self, before: int | None = None) -> dict:
        found = self.log.latest(before)
        return found[1] if found else {"batches": [], "counts": None, "cut": None, "rows": 0}

    def _keys(self, state: dict, begin: str, end: str) -> DataFrame:
        """Keys whose hashes lie in the folders from `begin` to `end`."""
        if not state["batches"]:
            return self.spark.createDataFrame([], _KEYS)
        folders = [self.log.folder(f"keys-{b:012d}") for b in state["batches"]]
        parts = [self.spark.read.schema(f"{_KEYS}, part string").parquet(f) for f in folders]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.filter(F.col("part").between(begin[:FOLDER_DIGITS], end[:FOLDER_DIGITS])).drop("part")

    def append(self, rows: DataFrame, batch: int) -> dict[str, int]:
        """Add a batch of rows; the numbers of rows, of training rows, and of earlier rows that changed sides. A repeated
        batch replaces itself."""
        old = self._state(batch)
        name = f"{batch:012d}"
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self.log.folder(f"rows-{name}"))
        stored = self.spark.read.schema(self.schema).parquet(self.log.folder(f"rows-{name}"))
        digest = order_hash(F.col(self.key), self.seed)
        keys = stored.select(digest.alias("_hash"), key_text(F.col(self.key)).alias("_key"))
        placed = keys.withColumn("part", F.substring("_hash", 1, FOLDER_DIGITS)).hint("rebalance", "part")
        placed.write.mode("overwrite").partitionBy("part").parquet(self.log.folder(f"keys-{name}"))
        state = {"batches": [*old["batches"], batch], "counts": f"counts-{name}"}
        counts = self._keys({"batches": [batch]}, "00", "ff").groupBy(F.substring("_hash", 1, BUCKET_DIGITS).alias("bucket"))
        counts = counts.agg(F.count(F.lit(1)).alias("n"))
        if old["counts"]:
            earlier = self.spark.read.schema("bucket string, n bigint").parquet(self.log.folder(old["counts"]))
            counts = counts.unionByName(earlier).groupBy("bucket").agg(F.sum("n").alias("n"))
        counts.coalesce(1).write.mode("overwrite").parquet(self.log.folder(state["counts"]))
        counts = self.spark.read.schema("bucket string, n bigint").parquet(self.log.folder(state["counts"]))
        total = counts.agg(F.sum("n")).first()[0] or 0
        place = cut_bucket(running_counts(counts), self.val_ratio) if total else None
        cut = place and cut_within(self._keys(state, place["bucket"], place["bucket"]), place)
        folders = [f"{kind}-{b:012d}" for b in state["batches"] for kind in ("rows", "keys")] + [state["counts"]]
        self.log.commit(batch, {**state, "cut": cut, "rows": total, "folders": folders})
        return {"rows": total, "train": int(total * (1 - self.val_ratio)), "moved": self._moved(old, cut)}

    def _moved(self, old: dict, cut: tuple | None) -> int:
        """Earlier rows between the cut before and the cut now."""
        ends = sorted(tuple(c[:3]) if c else ("", "", 0) for c in (old["cut"], cut))
        if ends[0] == ends[1]:
            return 0
        (h0, k0, n0), (h1, k1, n1) = ends
        key = F.struct("_hash", "_key")
        low, high = (F.struct(F.lit(h).alias("_hash"), F.lit(k).alias("_key")) for h, k in ((h0, k0), (h1, k1)))
        keys = self._keys(old, h0 or "00", h1)
        between, at_low, at_high = keys.agg(
            F.count_if((key > low) & (key < high)), F.count_if(key == low), F.count_if(key == high)
        ).first()
        if (h0, k0) == (h1, k1):
            return min(n1, at_low) - min(n0, at_low)
        return between + max(at_low - n0, 0) + min(n1, at_high)

    def labelled(self) -> DataFrame:
        """All rows with `split`, as `train_val_split` over all of them gives it."""
        state = self._state()
        if not state["batches"]:
            return self.spark.createDataFrame([], self.schema).withColumn("split", F.lit("val"))
        rows = self.spark.read.schema(self.schema).parquet(*(self.log.folder(f"rows-{b:012d}") for b in state["batches"]))
        return label_split(rows, self.key, tuple(state["cut"]) if state["cut"] else None, self.seed)
