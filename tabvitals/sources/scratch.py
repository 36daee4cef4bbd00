"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names in spark.checkpoint.dir.

    A session without the setting gets a folder of the warehouse, which a cluster shares too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/")
        root = f"{warehouse}/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to a shared folder and read from there: lost work is read, not redone."""
    path = folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
