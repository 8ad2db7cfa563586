"""Lines that many documents share are dropped from all of them but one.

A text is split at line feeds. A line's key is the line without ASCII white space at both ends, A-Z
lower-cased. A key of `least_length` code points or more that `least_docs` documents or more hold is
common: its lines stay only in the document with the largest id that holds it. Other lines stay as
they are and are joined again by line feeds.

Lines leave their texts only as two 64-bit hashes of the key, a position and a key of the row. Documents
are counted per hash in two steps, first one row for each (hash, document), then one for each hash, so a
line that a third of all documents hold is spread by document and combined before it meets. The common
hashes are written out; joined back by Spark (broadcast if their size allows, else with
skewed hashes split) they give the positions that each row loses. Only these go back to
the texts, which are shuffled once, and are taken out in one pass over the row's lines.

Nulls: a null text is one empty line, as is an empty one. A row without an id is no document in the
counts and no holder, so it loses every common line. Rows that share an id are one document in the counts;
each keeps its lines by the same rule. Very long texts and lines are hashed whole. Columns of the input
may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import BREAKS, let
from tidemark.session import settle

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased and no other letter."""
    bare = F.btrim(line, F.lit(BREAKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def two_hashes(*columns: Column) -> list[Column]:
    """128 bits as two independent longs."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def shared_lines(docs: DataFrame, least_length: int) -> DataFrame:
    """r1, r2 (of the row), doc_id, at (position from 0), h1, h2 (of the key) of every line long enough."""
    r1, r2 = two_hashes(F.col("doc_id"), F.col("text"))
    rows = docs.select(r1.alias("r1"), r2.alias("r2"), "doc_id", "text")  # hashed before, not after, they are taken apart
    lines = rows.select("r1", "r2", "doc_id", F.posexplode(split_lines(F.col("text"))).alias("at", "line"))
    # A key is no longer than its line: short lines go before any is trimmed.
    keys = lines.where(F.length("line") >= least_length).select("r1", "r2", "doc_id", "at", line_key(F.col("line")).alias("key"))
    h1, h2 = two_hashes(F.col("key"))
    return keys.where(F.length("key") >= least_length).select("r1", "r2", "doc_id", "at", h1.alias("h1"), h2.alias("h2"))


def common_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """h1, h2 and holder (the largest id with the line) of keys that enough documents hold."""
    held = lines.where("doc_id IS NOT NULL").groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    counted = held.groupBy("h1", "h2").agg(F.count("one").alias("n"), F.max("doc_id").alias("holder"))
    return counted.where(F.col("n") >= least_docs).select("h1", "h2", "holder")


def marked(docs: DataFrame, least_length: int, least_docs: int) -> DataFrame:
    """`docs`, of doc_id and text and more, with __lost (positions of lines, null for none)."""
    lines = settle(shared_lines(docs.select("doc_id", "text"), least_length))
    common = settle(common_lines(lines, least_docs))
    lost = lines.join(common, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("holder")))
    lost = lost.groupBy("r1", "r2").agg(F.collect_set("at").alias("__lost"))
    r1, r2 = two_hashes(F.col("doc_id"), F.col("text"))
    rows = docs.withColumns({"__r1": r1, "__r2": r2})
    return rows.join(lost, (F.col("__r1") == F.col("r1")) & (F.col("__r2") == F.col("r2")), "left").drop("__r1", "__r2", "r1", "r2")


def _kept_text() -> Column:
    """The lines that are not lost, by position; the text is split once."""

    def rejoined(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.array_join(F.transform(F.array_except(every, F.col("__lost")), lambda i: F.get(lines, i)), "\n")

    return F.when(F.col("__lost").isNull(), F.col("text")).otherwise(let(split_lines(F.col("text")), rejoined))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and text (the lines that stay; null only for null) of every row."""
    rows = marked(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), least_length, least_docs)
    lost = F.when(F.col("__lost").isNull(), 0).otherwise(F.size("__lost"))
    return rows.select("doc_id", F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"), lost.cast("long").alias("n_dropped"), _kept_text().alias("text"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 40, least_docs: int = 5) -> DataFrame:
    """All rows and columns of `docs`, the text without its common lines."""
    packed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.struct(*docs.columns).alias("__row"))
    rows = marked(packed, least_length, least_docs).select("__row", _kept_text().alias("__text"))
    return rows.select(*(F.col("__text").alias(c) if c == text else F.col("__row").getField(c).alias(c) for c in docs.columns))
