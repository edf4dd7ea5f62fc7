"""All queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cells, climate, core, deeper, demand, extras, flagship as first, modelling, placing, remainder, sampling, shaping, stores, texts, wider

MODULES = (first, core, wider, sampling, deeper, placing, demand, shaping, cells, stores, climate, texts, extras, modelling, remainder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
