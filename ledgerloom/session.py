"""Spark session and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A partition is replaced by naming it, so the static mode is the right one.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the package relies on; the cluster's own come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    without it is an error, since a machine-local folder is lost to the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = getattr(shared_folder, "local", None) or tempfile.mkdtemp(prefix="ledgerloom-")
    shared_folder.local = folder
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier call has returned."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several others. A written table survives the
    loss of executors and, unlike a cached one, is read column by column.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
