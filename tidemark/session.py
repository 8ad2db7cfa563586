"""Session settings and intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(name: str = "tidemark", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session; `SPARK_MASTER` and `SPARK_SHUFFLE_PARTITIONS` choose another master than local and another partition count than 8."""
    builder = (
        SparkSession.builder.master(os.environ.get("SPARK_MASTER", f"local[{cores}]"))
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", os.environ.get("SPARK_SHUFFLE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def settle(frame: DataFrame) -> DataFrame:
    """Compute a frame that feeds several branches of one query only once.

    On a cluster `spark.checkpoint.dir` names a folder that all executors share: the frame is
    written there and read back, so a lost executor costs no recomputation and the file sizes
    give the optimizer real statistics. Where it is unset, Spark keeps the rows itself, with
    their lineage (`persist`, in memory and on disk); nothing is ever put in a machine-local folder.
    """
    spark = frame.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return frame.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def work_folder(spark: SparkSession) -> str:
    """A new folder all executors share, for streams: under `spark.checkpoint.dir`, or else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
