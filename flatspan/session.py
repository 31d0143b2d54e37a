"""Session set-up and the shared folder stages are written to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package expects.  Ansi mode stays on (the Spark 4 default), so every
#: expression in the package uses try_* forms where a cast or a division may fail.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, also where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "flatspan", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package's settings; a master is given for local runs only."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a new temporary folder, remembered
    in the session so that later calls agree.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="flatspan-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_stage_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other stage uses."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage is cut, a lost executor costs
    one task and not the whole job."""
    path = new_stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
