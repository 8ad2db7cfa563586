"""New files to the observation table: each micro-batch is checked by the row rules of the observation contract, its good rows
reduced to one per key and written to its own folder, the others written with their issue beside them.

The cost of a batch depends on the batch alone. Readers merge the folders, the latest batch
winning by key; `compact` writes that merge as one folder now and then. A batch that runs
again after a failure writes the same two folders again, so every file counts once and every reject is listed once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.validate import with_issue
from tidemark.sources.landed import require_clean


def _latest_rows(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in frame.columns if c not in keys and c != "batch"]
    best = frame.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("__row"))
    return best.select(*keys, *(F.col(f"__row.{c}").alias(c) for c in rest))


def write_batches(root: str, keys: list[str], order: str, check: Callable[[DataFrame], DataFrame], quarantine: str | None = None):
    """A `foreachBatch` function that writes each checked batch to `batch=<id>` of two tables.

    `check` returns its rows with an `issue`, null for good ones. Without a quarantine a row with an issue ends the stream.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        checked = check(batch).persist()
        place = f"batch={batch_id:09d}"
        if quarantine is None:
            good = require_clean(checked, *keys)
        else:
            checked.where("issue IS NOT NULL").write.mode("overwrite").parquet(f"{quarantine}/{place}")
            good = checked.where("issue IS NULL").drop("issue")
        _latest_rows(good, keys, [order]).write.mode("overwrite").parquet(f"{root}/{place}")
        checked.unpersist()

    return apply


def run_ingest(stream: DataFrame, root: str, checkpoint: str, keys: list[str], order: str,
               check: Callable[[DataFrame], DataFrame] = lambda frame: frame.withColumn("issue", F.lit(None).cast("string")),
               quarantine: str | None = None) -> None:
    running = (
        stream.writeStream.foreachBatch(write_batches(root, keys, order, check, quarantine))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    running.awaitTermination()


def first_seen(stream: DataFrame, ids: list[str], time: str, delay: str) -> DataFrame:
    """Each id once, also across batches, while its time is within `delay` of the latest one; Spark forgets ids and drops rows older than that."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(ids)


def current(spark: SparkSession, root: str, keys: list[str], order: str) -> DataFrame:
    """One row per key over all batches."""
    return _latest_rows(spark.read.parquet(root), keys, ["batch", order])


def compact(spark: SparkSession, root: str, target: str, keys: list[str], order: str) -> None:
    """Write the merged table as the first batch of a new root."""
    current(spark, root, keys, order).write.mode("errorifexists").parquet(f"{target}/batch={0:09d}")


def rejected(spark: SparkSession, quarantine: str) -> DataFrame:
    """All rows that were not taken, with their issue and batch."""
    return spark.read.parquet(quarantine)


def event_observations(stream: DataFrame) -> DataFrame:
    """Events as rows of the observation contract, with the event's id."""
    text = lambda value: F.lit(value)
    kind, user = F.col("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return stream.select(
        "event_id", kind.alias("indicator_code"), kind.alias("indicator_name"), text("units").alias("unit"), text("daily").alias("frequency"),
        user.alias("region_code"), user.alias("region_name"), text("city").alias("region_level"), text(None).cast("string").alias("parent_region_code"),
        F.to_date("ts").alias("observation_date"), "value", text("events").alias("source_code"), text("Event stream").alias("source_name"),
        text("events").alias("source_url"), F.col("ts").alias("retrieved_at"),
    )


EVENT_KEYS = ["indicator_code", "region_code", "observation_date"]


def run_event_ingest(spark: SparkSession, source: str, table: str, quarantine: str, checkpoint: str,
                     change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Events as a stream of observations: the last good value per type, user and day wins, the rest is put aside. `change` alters rows before the check."""
    folder, pattern = source.rsplit("/", 1)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("pathGlobFilter", pattern).parquet(folder)
    run_ingest(change(event_observations(stream)), table, checkpoint, EVENT_KEYS, "retrieved_at", with_issue, quarantine)


def run_event_upsert(spark: SparkSession, source: str, table: str, quarantine: str, checkpoint: str) -> DataFrame:
    run_event_ingest(spark, source, table, quarantine, checkpoint)
    return current(spark, table, EVENT_KEYS, "retrieved_at").select(*EVENT_KEYS, "value")
