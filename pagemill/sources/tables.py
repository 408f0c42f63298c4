"""Parquet tables in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, heavy: bool = False) -> DataFrame:
    """A Parquet table.

    With `heavy`, for rows that cost much work each, a table that fills fewer scan tasks
    than there are cores is dealt out over all of them. Only a small table does: a large
    one already gives every core several splits and is read in place, without a shuffle.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if heavy and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores)
    return table
