"""Cuts long plans: rows are written to the session's checkpoint folder, so that lost executors cost no recomputation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session on one machine may leave it unset and then gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='trailhead-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/trailhead/{tag}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet under the shared folder and read again: columns and filters reach that scan."""
    path = new_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
