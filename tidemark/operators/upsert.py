"""Keyed merges without MERGE: combine old and new rows, write a new snapshot folder.

Every merge is one aggregate by key that compares candidates map-side, so loading the same
batch again changes nothing and a key with very many versions does not pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(current: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows by key; the batch wins over the current table, and in the batch the latest `order`."""
    columns = current.columns
    rest = [c for c in columns if c not in keys]
    rank = [F.lit(None).cast("timestamp_ntz")] if order is None else [F.col(order)]
    old = current.select(*columns, F.struct(F.lit(0), *rank, *rest).alias("__rank"))
    new = batch.select(*columns, F.struct(F.lit(1), *rank, *rest).alias("__rank"))
    merged = old.unionByName(new).groupBy(*keys).agg(F.max_by(F.struct(*rest), "__rank").alias("__row"))
    return merged.select(*(F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in columns))


def merge_metadata_history(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Versions by (indicator, source, hash): attributes of the latest sighting, widened period."""
    keys = ["indicator_code", "source_code", "metadata_hash"]
    spans = ["period_start", "period_end", "first_observed_at", "last_observed_at"]
    attributes = [c for c in history.columns if c not in keys + spans]
    return history.unionByName(batch).groupBy(*keys).agg(
        *(F.max_by(F.col(c), F.struct("last_observed_at", *attributes)).alias(c) for c in attributes),
        F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end"),
        F.min("first_observed_at").alias("first_observed_at"), F.max("last_observed_at").alias("last_observed_at"),
    ).select(history.columns)


def replace_children(parents_old: DataFrame, parents_new: DataFrame, children_old: DataFrame, children_new: DataFrame,
                     key: str) -> tuple[DataFrame, DataFrame]:
    """Parents upserted by key; the children of every new parent replaced as a whole."""
    fresh = parents_new.select(key).distinct()
    kept = children_old.join(fresh, key, "left_anti").unionByName(children_new)
    return upsert(parents_old, parents_new, [key]), kept


def write_snapshot(frame: DataFrame, root: str, version: str, partition_by: list[str] | None = None) -> str:
    """Write one immutable version of a table; an existing version is never overwritten."""
    path = f"{root.rstrip('/')}/version={version}"
    writer = frame.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version of a table, found by listing the version folders; no data of other versions is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    written = [n for n in names if n.startswith("version=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{n}/_SUCCESS"))]
    if not written:
        raise FileNotFoundError(f"no version of a table in {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{max(written)}")
