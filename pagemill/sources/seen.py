"""The URLs seen so far, asked by batches without rereading them.

URLs hash into buckets, each a folder of URLs, and once there is more than one bucket into segments, each with a Bloom filter of 2 ** 15 bits built and merged by Spark's bitmap
functions. A batch is first held against the
filters; only URLs that may have been seen are compared with stored ones, and
only in their buckets. So what a batch reads are the filters, whose size is set by the capacity,
and the buckets of URLs that come again. When the URLs outgrow the capacity it doubles,
and the filters are built anew from the URLs, which costs a constant share of adding them.

Every batch adds a generation of buckets and a version (see `snapshots`). FOLD generations of one
level are merged into one of the next, so a bucket has few folders however many batches
there were. A repeated batch asks the version before its own and replaces what it had added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import materialize
from pagemill.sources.snapshots import Snapshots

SEGMENT_BITS = 1 << 15  # bits of the filters that Spark's bitmap functions build
SEGMENT_URLS = 3_000  # about eleven bits a URL
PROBES = 4  # bits of a URL: about one new URL in fifty looks like a known one at full capacity
BUCKET_URLS = 1 << 20
FOLD = 8
CAPACITY = 1 << 18
FEW = 10_000  # rows that a join may send through the driver; Spark chooses by compressed size alone
SENT_SEGMENTS = 1 << 11  # segments, 4 kB each, of a filter that is sent to all tasks


def _power(n: int) -> int:
    return 1 << max(n - 1, 0).bit_length()


def _hash(seed: int, key: str) -> Column:
    return F.xxhash64(key) if seed == 0 else F.xxhash64(key, F.lit(seed))


def _slot(slots: int, key: str = "url") -> Column:
    """Segment or bucket of a URL; both counts are powers of two, so a bucket splits into whole buckets."""
    return F.pmod(_hash(0, key), F.lit(slots)).cast("int")


def _probe(i: int, key: str = "url") -> Column:
    return F.pmod(_hash(i + 1, key), F.lit(SEGMENT_BITS))


def _filters_of(urls: DataFrame, segments: int, key: str = "url") -> DataFrame:
    """(segment, bits) of the URLs."""
    probes = F.explode(F.array(*[_probe(i, key) for i in range(PROBES)])).alias("bit")
    return urls.select(_slot(segments, key).alias("segment"), probes).groupBy("segment").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def apart(rows: DataFrame, n: int) -> DataFrame:
    """A side of a join, of `n` rows or fewer, that is not broadcast unless it is small whatever it is compressed to."""
    return rows.hint("merge") if n > FEW else rows


def matched(rows: DataFrame, keys: DataFrame, key: str, n: int) -> DataFrame:
    """The inner join of wide `rows` with `n` rows of `keys`, unique on `key`. Many keys do not go through the driver: a
    Bloom filter of them, a fortieth of their size, goes to the rows, and only those that pass it are shuffled."""
    if n > FEW:
        segments = _power(-(-n // SEGMENT_URLS))
        filters = _filters_of(keys, segments, key).select(F.col("segment").alias("_segment"), F.col("bits").alias("_bits"))
        passed = rows.withColumn("_segment", _slot(segments, key)).join(F.broadcast(filters) if segments <= SENT_SEGMENTS else filters, "_segment")
        for i in range(PROBES):
            passed = passed.filter(_set(F.col("_bits"), _probe(i, key)))
        rows = passed.select(*rows.columns)
    return rows.join(apart(keys, n), key)


class SeenUrls:
    """The set stored at `path`. `capacity` is the number of URLs that the first filters are made for."""

    def __init__(self, spark: SparkSession, path: str, capacity: int = CAPACITY) -> None:
        self.spark, self.capacity = spark, capacity
        self.log = Snapshots(spark, path)

    def last(self) -> int | None:
        """The last batch added, None if there is none."""
        return max(self.log.versions(), default=None)

    def size(self, before: int | None = None) -> int:
        found = self.log.latest(before)
        return found[1]["total"] if found else 0

    def _filters(self, state: dict) -> DataFrame:
        return self.spark.read.schema("segment int, bits binary").parquet(self.log.folder(state["filters"]))

    def folders(self, state: dict, wanted: set[int] | None = None, slots: int = 1) -> list[str]:
        """Folders of the URLs in the `wanted` of `slots` buckets, or of all."""
        found = []
        for g in state["generations"]:
            least = min(slots, g["buckets"])
            slot = {w % least for w in wanted} if wanted is not None else None
            found += [f"{g['folder']}/bucket={b}" for b in g["used"] if slot is None or b % least in slot]
        return [self.log.folder(f) for f in found]

    def _urls(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], "url string")
        return self.spark.read.schema("url string").parquet(*folders)

    def _known(self, state: dict, wanted: set[int] | None = None, slots: int = 1) -> DataFrame:
        """The URLs of those folders, for the right side of a join: a set that grows is not broadcast in every batch."""
        return apart(self._urls(self.folders(state, wanted, slots)), state["total"])

    def maybe(self, urls: DataFrame, state: dict) -> DataFrame:
        """(url, bucket): the URLs that the filters do not rule out."""
        n = state["segments"]
        asked = urls.select("url", _slot(n).alias("segment")).join(self._filters(state), "segment")
        for i in range(PROBES):
            asked = asked.filter(_set(F.col("bits"), _probe(i)))
        return asked.select("url", _slot(state["buckets"]).alias("bucket"))

    def hits(self, urls: DataFrame, before: int | None = None) -> DataFrame:
        """(url): which of the unique `urls` have been added, in batches below `before` if it is given."""
        found = self.log.latest(before)
        if found is None:
            return self.spark.createDataFrame([], "url string")
        state = found[1]
        if state["filters"] is None:
            return urls.select("url").join(self._known(state), "url", "left_semi")
        maybe = materialize(self.maybe(urls, state), "maybe-seen")
        # At most one row for each bucket.
        wanted = {row["bucket"] for row in maybe.select("bucket").distinct().collect()}
        return maybe.select("url").join(self._known(state, wanted, state["buckets"]), "url", "left_semi")

    def unseen(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of `rows` (unique on url) whose URL has not been added."""
        found = self.log.latest(before)
        if found and found[1]["filters"] is None:
            return rows.join(self._known(found[1]), "url", "left_anti")
        return rows.join(apart(self.hits(rows.select("url"), before), found[1]["total"] if found else 0), "url", "left_anti")

    def add(self, urls: DataFrame, batch: int, count: int | None = None) -> int:
        """Add unique URLs that are not in the set as a batch; returns how many these are. A caller that
        knows the `count` passes a stored table, which is then not written once more for it."""
        found = self.log.latest(batch)
        state = found[1] if found else {"segments": _power(-(-self.capacity // SEGMENT_URLS)), "generations": [], "total": 0, "filters": None}
        if count is None:
            urls = materialize(urls.select("url"), "newly-seen")
            count = urls.count()
        total = state["total"] + count
        buckets = _power(-(-total // BUCKET_URLS))
        generations = list(state["generations"])
        if count:
            generations.append({"level": 0, **self._store(urls, f"urls/{batch:012d}", buckets)})
        while len(generations) >= FOLD and len({g["level"] for g in generations[-FOLD:]}) == 1:
            merged = generations[-FOLD:]
            level = merged[0]["level"] + 1
            rows = self._urls(self.folders({"generations": merged}))
            generations[-FOLD:] = [{"level": level, **self._store(rows, f"urls/{batch:012d}-{level}", buckets)}]
        segments = max(state["segments"], _power(-(-total // SEGMENT_URLS)))
        place = None
        if buckets > 1:
            if segments > state["segments"] or state["filters"] is None:
                # Room for as many again, so that the next building is far off.
                segments = max(state["segments"], 2 * _power(-(-total // SEGMENT_URLS)))
                filters = _filters_of(self._urls(self.folders({"generations": generations})), segments)
            else:
                both = self._filters(state).unionByName(_filters_of(urls, segments))
                filters = both.groupBy("segment").agg(F.bitmap_or_agg("bits").alias("bits"))
            place = f"filters/{batch:012d}"
            filters.write.mode("overwrite").parquet(self.log.folder(place))
        self.log.commit(batch, {
            "segments": segments, "buckets": buckets, "total": total, "filters": place, "generations": generations,
            "folders": [*([place] if place else []), *(g["folder"] for g in generations)],
        })
        return count

    def _store(self, urls: DataFrame, folder: str, buckets: int) -> dict:
        """Write URLs by bucket."""
        if buckets == 1:
            urls.select("url").write.mode("overwrite").parquet(self.log.folder(f"{folder}/bucket=0"))
            return {"folder": folder, "buckets": 1, "used": [0]}
        rows = urls.select("url", _slot(buckets).alias("bucket"))
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.log.folder(folder))
        used = [row["bucket"] for row in rows.select("bucket").distinct().collect()]
        return {"folder": folder, "buckets": buckets, "used": sorted(used)}
