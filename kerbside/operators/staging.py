"""Intermediate results that several steps share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see.

    That is what ``spark.checkpoint.dir`` (or ``setCheckpointDir``) names, else a folder in the session's
    warehouse. A warehouse on the machine's own disk serves a local master only; on a cluster each executor
    would write to its own disk, so that is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    home = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    if home.startswith(("file:", "/")) and master != "local" and not master.startswith("local["):
        raise ValueError("intermediate tables need a shared folder: set spark.checkpoint.dir")
    return f"{home}/staging"


def new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder, for plans that read them more than once.

    The table is a new one, or the one at ``path``, which it replaces.

    Unlike a cached or locally checkpointed table it survives the loss of executors, and its file sizes
    tell the planner whether it is small enough to broadcast.
    """
    path = path or new_path(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
