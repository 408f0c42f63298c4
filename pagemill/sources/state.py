"""Saved crawl progress: the visited URLs and the latest queue.

Every save is a numbered generation: the URLs visited since the one before, and the queue as a whole. A
version file written last puts it in force (see `snapshots`), so a save that dies half-way leaves the
previous one in force. FOLD generations of visited URLs of one level are folded into one of the next,
and queues that no kept version names are deleted: a load reads few folders however many saves there were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.schemas import FRONTIER, VISITED
from pagemill.sources.paths import exists
from pagemill.sources.snapshots import Snapshots

FOLD = 8
_COMMIT = T.StructType([T.StructField("generation", T.LongType()), T.StructField("start", T.LongType())])


def _current(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the last complete save, -1 if there is none. Anything but a
    missing state, such as an unreadable one, raises."""
    found = Snapshots(spark, path).latest()
    if found:
        return found
    # The layout before version files: a table of commits.
    if not exists(spark, f"{path}/commits"):
        return -1, None
    last, start = spark.read.schema(_COMMIT).parquet(f"{path}/commits").agg(F.max("generation"), F.max("start")).first()
    if last is None:
        return -1, None
    visited = [{"folder": f"visited/generation={g}", "level": 0} for g in range(start, last + 1)]
    return last, {"visited": visited, "frontier": f"frontier/generation={last}"}


def _visited(spark: SparkSession, path: str, generations: list[dict]) -> DataFrame:
    if not generations:
        return spark.createDataFrame([], VISITED)
    return spark.read.schema(VISITED).parquet(*(f"{path}/{g['folder']}" for g in generations))


def save_state(
    newly_visited: DataFrame, frontier: DataFrame, path: str, fresh: bool = False
) -> int:
    """Add URLs visited since the last save and store the queue as it is now. With `fresh`
    the saves before this one no longer count. Returns the number of the save."""
    spark = frontier.sparkSession
    log = Snapshots(spark, path)
    last, state = (max(log.versions(), default=-1), None) if fresh else _current(spark, path)
    generation = last + 1
    visited = [*(state["visited"] if state else []), {"folder": f"visited/generation={generation}", "level": 0}]
    newly_visited.select(*VISITED.names).write.mode("overwrite").parquet(f"{path}/{visited[-1]['folder']}")
    queue = f"frontier/generation={generation}"
    frontier.select(*FRONTIER.names).write.mode("overwrite").parquet(f"{path}/{queue}")
    while len(visited) >= FOLD and len({g["level"] for g in visited[-FOLD:]}) == 1:
        level = visited[-1]["level"] + 1
        folder = f"visited/generation={generation}-level={level}"
        _visited(spark, path, visited[-FOLD:]).write.mode("overwrite").parquet(f"{path}/{folder}")
        visited[-FOLD:] = [{"folder": folder, "level": level}]
    log.commit(generation, {"visited": visited, "frontier": queue, "folders": [queue, *(g["folder"] for g in visited)]})
    return generation


def load_state(spark: SparkSession, path: str, fresh: bool = False) -> tuple[DataFrame, DataFrame]:
    """(visited, frontier) of the last complete save; empty tables if there is none or if
    `fresh` asks to ignore it."""
    state = None if fresh else _current(spark, path)[1]
    if state is None:
        return spark.createDataFrame([], VISITED), spark.createDataFrame([], FRONTIER)
    return _visited(spark, path, state["visited"]), spark.read.schema(FRONTIER).parquet(f"{path}/{state['frontier']}")
