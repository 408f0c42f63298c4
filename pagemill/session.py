"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pagemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are meant to run with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"pagemill-{app_id}-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local-mode session, which has a single machine, may fall back to a folder of
    its own; on a cluster a machine-local folder would vanish with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        return _local_scratch(spark.sparkContext.applicationId)
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the scratch folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the real size of
    the table when it chooses between a broadcast and a shuffled join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
