"""Results of several parts that readers see as a whole: all old or all new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from pagemill.sources.snapshots import Snapshots


def publish(spark: SparkSession, path: str, *parts: Callable[[str], object]) -> str:
    """Let each of `parts` write below a new folder, then put that folder in force; the folder. If a part dies,
    the one before stays in force. The folder before it stays for readers that are still at it."""
    log = Snapshots(spark, path)
    found = log.latest()
    version = found[0] + 1 if found else 0
    folder = f"data/{version:012d}"
    for part in parts:
        part(log.folder(folder))
    log.commit(version, {"folders": [folder]})
    return log.folder(folder)


def published(spark: SparkSession, path: str) -> str | None:
    """The folder in force, None if nothing has been published."""
    log = Snapshots(spark, path)
    found = log.latest()
    return log.folder(found[1]["folders"][0]) if found else None
