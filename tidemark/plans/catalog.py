"""Loads every query module and hands out the registered queries."""

import importlib
import pkgutil

import tidemark.plans as plans
from tidemark.plans.registry import ORACLES, QUERIES, with_tables

for _module in sorted(m.name for m in pkgutil.iter_modules(plans.__path__) if m.name.startswith("q_")):
    importlib.import_module(f"tidemark.plans.{_module}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {name: with_tables(sql) for name, sql in ORACLES.items()}
