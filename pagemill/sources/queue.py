"""The crawl queue of a stream, kept up batch by batch.

The queue holds the URLs that stored pages link to and that are not stored themselves, each at
its earliest place. A batch changes it by what the batch brings: links to URLs that no batch
linked to before are added, unless their pages are stored; URLs that were linked to before
and whose pages arrive are struck out. Both are appended, and folded into the live queue once what is struck out makes up
half of it or FOLD batches lie side by side; the cost of folding is a constant share of that of adding.

A repeated batch starts from the versions before its own, see `snapshots`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.curate import first_per_key
from pagemill.schemas import FRONTIER
from pagemill.sources.seen import SeenUrls
from pagemill.sources.snapshots import Snapshots

FOLD = 16


class CrawlQueue:
    """The queue stored at `path`, with the URLs linked to so far."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.log = Snapshots(spark, f"{path}/queue")
        self.linked = SeenUrls(spark, f"{path}/linked")

    def _read(self, folders: list[str], schema) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*map(self.log.folder, folders))

    def _live(self, state: dict) -> DataFrame:
        added = self._read(state["added"], FRONTIER)
        return added.join(self._read(state["gone"], "url string"), "url", "left_anti") if state["gone"] else added

    def now(self) -> DataFrame:
        """(url, depth, src_ord, pos): the queue after the last batch."""
        found = self.log.latest()
        return self._live(found[1]) if found else self.spark.createDataFrame([], FRONTIER)

    def take_in(self, links: DataFrame, stored: DataFrame, pages: SeenUrls, batch: int) -> int:
        """Bring the queue up to a batch: its `links` (frontier columns) and its `stored` pages (url),
        which `pages` counts as seen already. Returns how many URLs are queued then."""
        found = self.log.latest(batch)
        state = found[1] if found else {"added": [], "gone": [], "n_added": 0, "n_gone": 0}
        place = f"{batch:012d}"
        gone = self.linked.hits(stored.select("url"), before=batch)
        gone.write.mode("overwrite").parquet(self.log.folder(f"gone-{place}"))
        order = [F.col(c) for c in ("depth", "src_ord", "pos")]
        first = first_per_key(links.select(*FRONTIER.names), F.col("url"), order)
        fresh = self.linked.unseen(first, before=batch)
        fresh.write.mode("overwrite").parquet(self.log.folder(f"fresh-{place}"))
        fresh = self._read([f"fresh-{place}"], FRONTIER)
        pages.unseen(fresh, before=batch + 1).write.mode("overwrite").parquet(self.log.folder(f"added-{place}"))
        self.linked.add(fresh.select("url"), batch)

        state = {
            "added": [*state["added"], f"added-{place}"],
            "gone": [*state["gone"], f"gone-{place}"],
            "n_added": state["n_added"] + self._read([f"added-{place}"], FRONTIER).count(),
            "n_gone": state["n_gone"] + self._read([f"gone-{place}"], "url string").count(),
        }
        if len(state["added"]) > FOLD or 2 * state["n_gone"] > state["n_added"]:
            live = f"live-{place}"
            self._live(state).write.mode("overwrite").parquet(self.log.folder(live))
            state = {"added": [live], "gone": [], "n_added": self._read([live], FRONTIER).count(), "n_gone": 0}
        # The fresh links are needed for this batch alone; the next version lets them go.
        self.log.commit(batch, {**state, "folders": [*state["added"], *state["gone"], f"fresh-{place}"]})
        # Whatever is struck out was queued: a page that was linked to before and arrives now.
        return state["n_added"] - state["n_gone"]
