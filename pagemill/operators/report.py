"""Run totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW_ENTRIES = 10  # fixed value: warn below this many


def prep_summary(raw: DataFrame, split: DataFrame) -> DataFrame:
    """One row: files and records read, unique entries left after the dedup and the length
    filter, sizes of both parts, and the few-entries flag.

    `raw` has `file_name`. Files are counted by grouping first, which leaves one row per
    file and task before the shuffle.
    """
    files = raw.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    totals = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.lit(0).cast("bigint").alias("train"),
        F.lit(0).cast("bigint").alias("val"),
    )
    parts = split.agg(
        F.lit(0).cast("bigint").alias("files"),
        F.lit(0).cast("bigint").alias("records"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
    )
    both = totals.unionByName(parts).agg(
        *(F.sum(c).alias(c) for c in ("files", "records", "train", "val"))
    )
    entries = F.col("train") + F.col("val")
    return both.withColumns({"entries": entries, "few_entries": entries < FEW_ENTRIES})
