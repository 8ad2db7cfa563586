"""Column expressions on texts that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BETWEEN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space, in order; null and empty texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BETWEEN))


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def count_characters(text: Column, characters: str) -> Column:
    """How many code points of a text are among the given ones."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def set_aside(frame: DataFrame, names: set[str]) -> tuple[DataFrame, list[Column]]:
    """The frame with columns of these names renamed to free ones, and the columns that give its own back."""
    taken, renamed, back = {c.lower() for c in frame.columns}, {}, []
    for c in frame.columns:
        fresh = c
        if c.lower() in names:
            fresh = f"{c}_aside"
            while fresh.lower() in taken:
                fresh += "_"
            taken.add(fresh.lower())
            renamed[c] = fresh
        back.append(F.col(f"`{fresh}`").alias(c))
    return frame.withColumnsRenamed(renamed), back
