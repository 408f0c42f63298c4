"""Visited set, crawl queue and reachability as semi/anti joins over tables.

Queue order is (depth, src_ord, pos) ascending, see `schemas.FRONTIER`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.operators.curate import first_per_key
from pagemill.schemas import FRONTIER
from pagemill.session import materialize, scratch_path

QUEUE_ORDER = ("depth", "src_ord", "pos")
PRUNE_FROM = 100_000  # pages reached before links are first dropped
PRUNE_GROWTH = 4  # growth of the crawl from one dropping of links to the next
FOLD = 32  # levels compared one by one; bounds what a level lists on a long chain
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _queue_order():
    return [F.col(c) for c in QUEUE_ORDER]


def visit_gate(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """URLs that may be visited now: each once, none visited before.

    Candidates are made unique first, so the anti join meets no hot key on either side
    and reuses the same partitioning by URL.
    """
    return candidates.select("url").dropDuplicates(["url"]).join(
        visited.select("url"), "url", "left_anti"
    )


def frontier_next(links: DataFrame, visited: DataFrame, frontier: DataFrame) -> DataFrame:
    """The queue after adding `links`: what was queued, and each new URL once at its
    earliest place. `links` has the frontier's columns.

    URLs are made unique before the anti join: a link found on every page is cut to one
    row per map task before it is shuffled, and the join reuses that partitioning.
    """
    queued = frontier.select(*FRONTIER.names).withColumn("_new", F.lit(0))
    found = links.select(*FRONTIER.names).withColumn("_new", F.lit(1))
    return (
        first_per_key(queued.unionByName(found), F.col("url"), [F.col("_new"), *_queue_order()])
        .drop("_new")
        .join(visited.select("url"), "url", "left_anti")
    )


def resume_frontier(frontier: DataFrame, visited: DataFrame, seed: str) -> DataFrame:
    """A loaded queue without visited URLs, with the seed put first if it is in neither set."""
    spark = frontier.sparkSession
    start = spark.createDataFrame([(seed, 0, -1, 0)], FRONTIER).withColumn("_new", F.lit(1))
    both = frontier.select(*FRONTIER.names).withColumn("_new", F.lit(0)).unionByName(start)
    return (
        first_per_key(both, F.col("url"), [F.col("_new"), *_queue_order()])
        .drop("_new")
        .join(visited.select("url"), "url", "left_anti")
    )


def resume_counts(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """One row (visited, queued)."""
    marked = visited.select(F.lit(1).alias("v")).unionAll(frontier.select(F.lit(0).alias("v")))
    return marked.agg(
        F.count_if(F.col("v") == 1).alias("visited"), F.count_if(F.col("v") == 0).alias("queued")
    )


def frontier_batch(frontier: DataFrame, n: int) -> DataFrame:
    """The `n` oldest queue entries (a top-n, not a full sort)."""
    return frontier.orderBy(*_queue_order()).limit(n)


_LEVEL = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("ord", T.LongType()),
])


def crawl_reachable(
    links: DataFrame | Callable[[DataFrame], DataFrame],
    seed: str,
    max_pages: int = 0,
    max_depth: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """(url, depth, visit_rank, visited): pages reached from `seed` over `links`
    (src_url, pos, url), breadth first, each URL once.

    Within a level pages come in the order of the parent's rank, then of the link's
    position. With `max_pages` the first that many are visited; the rest of the queue at
moment is returned with visited = false. `unique` says that no (src_url, url) repeats in
    `links`, which spares a shuffle of all of them. `links` may also be a function from the
    pages of a level (src_url) to their unique links, for a crawl that ends long before it
    has seen all.

    Each level is one job whose result is written to the scratch folder, so lineage does
    not grow and a lost executor repeats one level at most. Level tables are narrow, and
    the planner sees their true size: a small frontier is broadcast against the links, a
    large one is joined by shuffle. Each time the crawl has grown several times over, and
    every FOLD levels, links to pages already reached are dropped for good; the many small levels at the end then
    read what little is left, and compare it with the levels since only.
    """
    looked_up = callable(links)
    spark = SparkSession.active() if looked_up else links.sparkSession
    if not looked_up:
        if not unique:
            links = links.groupBy("src_url", "url").agg(F.min("pos").alias("pos"))
        edges = materialize(links.select("src_url", "url", "pos"), "edges")
    base = scratch_path(spark, "levels")
    schema = T.StructType([*_LEVEL.fields, T.StructField("depth", T.IntegerType())])

    def levels(first: int, last: int) -> DataFrame:
        paths = [f"{base}/depth={d}" for d in range(first, last + 1)]
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)

    spark.createDataFrame([(seed, 0)], _LEVEL).coalesce(1).write.parquet(f"{base}/depth=0")
    depth, total = 0, 1  # last level written, pages in all levels
    pruned, pruned_total = -1, 0  # last level that no edge leads to any more
    while True:
        cut = bool(max_pages) and total >= max_pages
        if not cut and max_depth is not None and depth >= max_depth:
            break
        level = levels(depth, depth)
        if cut:
            ranked = _with_visit_rank(levels(0, depth))
            level = ranked.filter((F.col("depth") == depth) & (F.col("visit_rank") <= max_pages))
        grown = total >= max(PRUNE_FROM, PRUNE_GROWTH * pruned_total) or depth - pruned > FOLD
        if grown and not looked_up:
            reached = levels(pruned + 1, depth).select("url")
            edges = materialize(edges.join(reached, "url", "left_anti"), "edges")
            pruned, pruned_total = depth, total
        parents = level.select(F.col("url").alias("src_url"), F.col("ord").alias("src_ord"))
        if looked_up:
            edges = links(materialize(parents.select("src_url"), "level"))
        # Plain integers are combined by hashing; a struct of them would be sorted.
        found = (
            edges.join(parents, "src_url")
            .groupBy("url")
            .agg(F.min("src_ord").alias("src_ord"), F.min_by("pos", "src_ord").alias("pos"))
        )
        if pruned < depth:
            found = found.join(levels(pruned + 1, depth).select("url"), "url", "left_anti")
        size = Observation()
        (
            found.orderBy("src_ord", "pos")
            .select("url", F.monotonically_increasing_id().alias("ord"))
            .observe(size, F.count(F.lit(1)).alias("pages"))
            .write.parquet(f"{base}/depth={depth + 1}")
        )
        depth += 1
        total += size.get["pages"]
        if cut or size.get["pages"] == 0:
            break
    ranked = _with_visit_rank(levels(0, depth))
    visited = F.lit(True) if not max_pages else F.col("visit_rank") <= max_pages
    return ranked.select("url", "depth", "visit_rank", visited.alias("visited"))


def _with_visit_rank(levels: DataFrame) -> DataFrame:
    """Rank over (depth, ord), from 1. `ord` numbers the sorted partitions of a level
    without gaps, so a rank is the row's number in its partition plus the rows of all
    partitions before it: one small count per partition, no global sort."""
    part = F.shiftright(F.col("ord"), ROW_BITS)
    row = F.col("ord").bitwiseAND((1 << ROW_BITS) - 1)
    numbered = levels.withColumn("_part", part)
    counts = numbered.groupBy("depth", "_part").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(
        "depth",
        "_part",
        (F.sum("n").over(Window.orderBy("depth", "_part")) - F.col("n")).alias("_start"),
    )
    return (
        numbered.join(starts, ["depth", "_part"])
        .withColumn("visit_rank", F.col("_start") + row + 1)
        .drop("_part", "_start")
    )
