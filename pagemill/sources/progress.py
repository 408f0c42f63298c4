"""The order of a crawl as a stored list, and how far it has come.

A crawl that takes the oldest URL of its queue first visits URLs in the order in which it finds them.
So visited URLs and queue are one list that only grows: every URL found has a place, the
visited ones are those before `head`, the others are queued, and the next n are the
places from `head` on. Nothing is sorted or ranked to take them. New URLs get their places from
the counts of sorted partitions.

Each round adds a folder of found URLs and a version (see `snapshots`) that says where it begins; a
round that dies leaves the version before in force and is done again. Whether a URL
has been found is asked of `SeenUrls`, which does not reread the list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagemill.sources.seen import SeenUrls
from pagemill.sources.snapshots import Snapshots

_FOUND = "url string, depth int, src_ord bigint, pos int, part int, line bigint"
LINE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits

#: From a round's URLs (url, depth, place), their number and the round's version to the links found on their pages (url, src_ord, pos).
Visit = Callable[[DataFrame, int, int], DataFrame]


class CrawlProgress:
    """The list at `path`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.log = Snapshots(spark, f"{self.path}/order")
        self._seen: dict[str, SeenUrls] = {}

    def state(self) -> dict | None:
        latest = self.log.latest()
        return latest[1] if latest and latest[1]["first"] < latest[1]["tail"] else None

    def start(self, seed: str) -> dict:
        """Begin anew, whatever was saved: a list of its own, with the seed alone."""
        latest = self.log.latest()
        version = latest[0] + 1 if latest else 0
        first = latest[1]["tail"] if latest else 0
        # Places and URLs of an earlier crawl stay where they are; those of this one come after them.
        row = self.spark.createDataFrame([(seed, 0, -1, 0, 0, 0)], _FOUND).coalesce(1)
        folder, seen = f"found-{version:012d}", f"seen-{version:012d}"
        row.write.mode("overwrite").parquet(self.log.folder(folder))
        self.seen(seen).add(row.select("url"), version, count=1)
        return self._commit(version, {
            "seen": seen, "first": first, "head": first, "tail": first + 1,
            "rounds": [{"folder": folder, "from": first, "upto": first + 1, "starts": [[0, first]]}], "records": [],
        })

    def seen(self, name: str) -> SeenUrls:
        if name not in self._seen:
            self._seen[name] = SeenUrls(self.spark, f"{self.path}/{name}")
        return self._seen[name]

    def _commit(self, version: int, state: dict) -> dict:
        folders = [r["folder"] for r in state["rounds"]] + state["records"]
        self.log.commit(version, {**state, "folders": folders})
        return state

    def places(self, state: dict, begin: int, end: int) -> DataFrame:
        """(url, depth, src_ord, pos, place) of the places from `begin` up to `end`. Only rounds that hold
        some are read, and of those only partitions that do."""
        parts = []
        for r in state["rounds"]:
            if r["from"] < end and r["upto"] > begin:
                starts = dict(r["starts"])
                upto = dict(zip(starts, [*list(starts.values())[1:], r["upto"]]))
                known = [p for p in starts if starts[p] < end and upto[p] > begin]
                rows = self.spark.read.schema(_FOUND).parquet(self.log.folder(r["folder"]))
                rows = rows.filter(F.col("part").between(min(known), max(known)))
                offset = F.create_map(*[F.lit(x) for p in known for x in (p, starts[p])])
                place = F.element_at(offset, F.col("part")) + F.col("line")
                parts.append(rows.withColumn("place", place.cast("bigint")).filter(F.col("place").between(begin, end - 1)))
        if not parts:
            return self.spark.createDataFrame([], f"{_FOUND}, place bigint").drop("part", "line")
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.drop("part", "line")

    def visited(self, state: dict) -> DataFrame:
        return self.places(state, state["first"], state["head"])

    def queue(self, state: dict) -> DataFrame:
        return self.places(state, state["head"], state["tail"])

    def advance(self, visit: Visit, seed: str, n: int, fresh: bool = False, records: bool = False) -> dict:
        """Visit the next `n` URLs, in as many rounds as the queue needs to fill up again; the state
        then. With `records` a round's folder `records-<version>` is kept with it."""
        state = None if fresh else self.state()
        if state is None:
            state = self.start(seed)
        left, version = n, self.log.latest()[0]
        while left > 0 and state["head"] < state["tail"]:
            end = min(state["head"] + left, state["tail"])
            version += 1
            links = visit(self.places(state, state["head"], end).select("url", "depth", "place"), end - state["head"], version)
            left -= end - state["head"]
            state = self._take_in(links, {**state, "head": end}, version, records)
        return state

    def _take_in(self, links: DataFrame, state: dict, version: int, records: bool) -> dict:
        # Plain integers are combined by hashing ahead of the shuffle, however often a URL is linked to.
        # The first page that links to a URL is also the one of least depth.
        first = links.groupBy("url").agg(
            F.min("depth").alias("depth"), F.min("src_ord").alias("src_ord"), F.min_by("pos", "src_ord").alias("pos")
        )
        seen = self.seen(state["seen"])
        new = seen.unseen(first, before=version).orderBy("src_ord", "pos").withColumn("_id", F.monotonically_increasing_id())
        folder = f"found-{version:012d}"
        place = {"part": F.shiftright("_id", LINE_BITS).cast("int"), "line": F.col("_id").bitwiseAND((1 << LINE_BITS) - 1)}
        size = Observation()
        new = new.withColumns(place).drop("_id").observe(size, F.count(F.lit(1)).alias("n"), F.max("part").alias("last"))
        new.write.mode("overwrite").parquet(self.log.folder(folder))
        rows = self.spark.read.schema(_FOUND).parquet(self.log.folder(folder))
        counts = [(0, size.get["n"])] if size.get["n"] else []
        if size.get["last"]:
            # A row for each partition of the sort.
            counts = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
        at, starts = state["tail"], []
        for part, n in counts:
            starts.append([part, at])
            at += n
        seen.add(rows.select("url"), version, count=at - state["tail"])
        found = [{"folder": folder, "from": state["tail"], "upto": at, "starts": starts}] if counts else []
        kept = [f"records-{version:012d}"] if records else []
        return self._commit(version, {**state, "tail": at, "rounds": state["rounds"] + found, "records": state["records"] + kept})
