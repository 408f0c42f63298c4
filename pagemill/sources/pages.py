"""A keyed store of page records that does not grow with overwritten ones.

A save adds its records, by the hash of their URL, to the buckets they fall into, at the cost of the batch. A
bucket of more than FOLD folders is folded: of each URL the latest record stays. Only those buckets are
rewritten, all but their newest folder, and aside; the version file that names them is written last (see `snapshots`). A
save that dies leaves the version before whole, and readers of it keep its folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.operators.curate import upsert_pages
from pagemill.sources.paths import names_in
from pagemill.sources.snapshots import Snapshots

BUCKETS = 16
FOLD = 4


def _batches(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def _write(rows: DataFrame, log: Snapshots, folder: str, buckets: int) -> list[int]:
    """Write records by bucket; the buckets that got some."""
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(log.folder(folder))
    return [int(name[8:]) for name in names_in(log.spark, log.folder(folder)) if name.startswith("_bucket=")]


def save_pages(pages: DataFrame, path: str, batch: int, buckets: int = BUCKETS) -> None:
    """Add one batch of records; `seq` gives the order of writes within the batch. Saving a batch once more
    replaces it, as long as none of it has been folded, which is never so for the last one. The number of buckets is set by the first save."""
    log = Snapshots(pages.sparkSession, path)
    found = log.latest()
    version, state = (found[0] + 1, found[1]) if found else (0, {"buckets": buckets, "parts": {}, "folded": []})
    if batch in state["folded"]:
        raise ValueError(f"batch {batch} is part of folded buckets and can't be replaced")
    parts = {b: [f for f in folders if f["batch"] != batch] for b, folders in state["parts"].items()}
    folder = f"data/{version:012d}"
    rows = pages.withColumn("batch", F.lit(batch).cast("bigint"))
    for b in _write(rows, log, folder, state["buckets"]):
        parts[str(b)] = [*parts.get(str(b), []), {"folder": f"{folder}/_bucket={b}", "batch": batch}]
    full, folded = [b for b, folders in parts.items() if len(folders) > FOLD], set(state["folded"])
    if full:
        folder = f"data/{version:012d}-folded"
        held = [f["folder"] for b in full for f in parts[b][:-1]]
        latest = upsert_pages(_read(pages.sparkSession, log, held, _batches(pages.schema)), "url", ("batch", "seq"))
        _write(latest, log, folder, state["buckets"])
        folded |= {f["batch"] for b in full for f in parts[b][:-1] if f["batch"] is not None}
        parts.update({b: [{"folder": f"{folder}/_bucket={b}", "batch": None}, parts[b][-1]] for b in full})
    folders = sorted({f["folder"] for known in parts.values() for f in known})
    log.commit(version, {"buckets": state["buckets"], "parts": parts, "folded": sorted(folded), "folders": folders})


def _read(spark: SparkSession, log: Snapshots, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*map(log.folder, folders))


def load_pages(
    spark: SparkSession, path: str, schema: T.StructType, by: str = "url"
) -> DataFrame:
    """The latest record of every URL, or of every host and slug."""
    log = Snapshots(spark, path)
    found = log.latest()
    return upsert_pages(_read(spark, log, found[1]["folders"] if found else [], _batches(schema)), by, ("batch", "seq"))
