"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Folders of sessions that name none, removed when the driver ends.
_OWN: list[tempfile.TemporaryDirectory] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a local one of our own only in local mode."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} must name a folder every executor can reach")
    if not _OWN:
        _OWN.append(tempfile.TemporaryDirectory(prefix="shiplens-", ignore_cleanup_errors=True))
    return _OWN[0].name


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Written once and read back: later passes neither recompute it nor depend on the
    executors that made it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
