"""Labelled CSV and whole-run JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(frame: DataFrame, labels: dict[str, str]) -> DataFrame:
    return frame.select(*(F.col(c).alias(label) for c, label in labels.items()))


def write_csv(frame: DataFrame, path: str, labels: dict[str, str]) -> None:
    """Quote where needed, double inner quotes, leave NULL empty."""
    (
        labelled(frame, labels).write.option("header", True).option("quote", '"').option("escape", '"')
        .option("nullValue", "").option("emptyValue", "").csv(path)
    )


def csv_cell(column: Column) -> Column:
    """One CSV field: quoted only if it holds a quote, comma or line break."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('["\\r\\n,]'), quoted).otherwise(text)


def csv_lines(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.select(F.concat_ws(",", *(csv_cell(F.col(c)) for c in columns)).alias("line"))


def run_documents(runs: DataFrame, key: str, children: dict[str, DataFrame]) -> DataFrame:
    """One JSON document per run with its child rows nested in key order.

    Children are bounded per run (holdout length, horizon, one event per calendar slot).
    """
    result = runs
    for name, child in children.items():
        columns = [c for c in child.columns if c != key]
        nested = child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
        result = result.join(nested, key, "left")
    fields = [F.coalesce(F.col(n), F.array()).alias(n) if n in children else F.col(n) for n in result.columns]
    return result.select(key, F.to_json(F.struct(*fields)).alias("document"))


def write_documents(documents: DataFrame, path: str) -> None:
    documents.select("document").write.text(path)
