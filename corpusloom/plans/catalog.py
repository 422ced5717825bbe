"""Every query of the library by name, with the SQL that has the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.plans import relational, release, sources, stores, structure, texts, validation

MODULES = (relational, structure, texts, validation, stores, release, sources)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
