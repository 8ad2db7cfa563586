"""As-of lookups by ordered windows: no range join, no row blow-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_last(frame: DataFrame, keys: list[str], date: str, columns: dict[str, str]) -> DataFrame:
    """Carry the last known value of each column forward, under a new name."""
    upto = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return frame.withColumns({new: F.last(old, ignorenulls=True).over(upto) for old, new in columns.items()})


def asof_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_date: str, right_date: str, value: str, chunk: str = "HOUR"
) -> DataFrame:
    """For every left row, the value of the last right row dated on or before it.

    Both sides go into one stream, cut by key and time chunk. Inside a chunk the last value
    is carried by an ordered window, right rows first on equal dates; what earlier chunks
    leave behind comes from one row per chunk. A key with very many rows is thus spread over
    its chunks; the chunk should be short enough that one key's rows in it fit a task. Right rows are combined to one per key and date before the shuffle.
    """
    marks = right.groupBy(*keys, F.col(right_date).alias("__date")).agg(F.max(value).alias("__value"))
    columns = [c for c in left.columns if c not in keys]
    rows = left.select(*keys, F.struct(*columns).alias("__row"), F.col(left_date).alias("__date"), F.lit(1).alias("__side"))
    stream = rows.unionByName(marks.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    stream = stream.withColumn("__chunk", F.date_trunc(chunk, "__date"))

    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    in_chunk = F.when(F.col("__value").isNotNull(), F.col("__date"))
    carried = (
        stream.groupBy(*keys, "__chunk").agg(F.max_by("__value", in_chunk).alias("__last"))
        .withColumn("__carry", F.last("__last", ignorenulls=True).over(before))
        .where(F.col("__carry").isNotNull()).drop("__last")
    )
    upto = Window.partitionBy(*keys, "__chunk").orderBy("__date", "__side").rowsBetween(Window.unboundedPreceding, 0)
    joined = (
        stream.withColumn("__value", F.last("__value", ignorenulls=True).over(upto)).where("__side = 1")
        .join(carried, [*keys, "__chunk"], "left")
    )
    return joined.select(
        *keys, *(F.col(f"__row.{c}").alias(c) for c in columns), F.coalesce("__value", "__carry").alias(value)
    )
