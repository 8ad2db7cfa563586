"""The registered queries, each next to the SQL that must give the same rows.

SQL texts may name any common table expression of `oracle_tables`; those a text uses are
put in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.oracle_tables import TABLES
from tidemark.sources.lake import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a `Lake` under a name, with its SQL where SQL can say it."""

    def register(build: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: plain(build(Lake(spark, folder)))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def plain(frame: DataFrame) -> DataFrame:
    """Result types every SQL engine shares: exact numbers become doubles with six digits."""
    columns = []
    for name, kind in frame.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal") or kind in ("double", "float"):
            column = F.round(column.cast("double"), 6)
            column = F.when(column == 0, F.lit(0.0)).otherwise(column)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind == "boolean":
            column = column.cast("int").cast("bigint")
        columns.append(column.alias(name))
    return frame.select(*columns)


def shorthand(sql: str) -> str:
    """`R(x)`: x as a double with six digits. `I(x)`: x as a 64-bit integer."""
    found = re.search(r"\b([RI])\(", sql)
    while found:
        depth, at = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[at], 0)
            at += 1
        inner = sql[found.end():at - 1]
        new = f"round(CAST(({inner}) AS DOUBLE), 6)" if found[1] == "R" else f"CAST(({inner}) AS BIGINT)"
        sql = sql[:found.start()] + new + sql[at:]
        found = re.search(r"\b([RI])\(", sql)
    return sql


def with_tables(sql: str) -> str:
    return shorthand(_with_tables(sql))


def _with_tables(sql: str) -> str:
    used: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(TABLES[name])
                used.append(name)

    visit(sql)
    body = sql.strip()
    if not used:
        return body
    head = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in used)
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH RECURSIVE {head},\n{body[len('WITH'):]}"
    return f"WITH RECURSIVE {head}\n{body}"
