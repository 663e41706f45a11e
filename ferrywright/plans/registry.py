"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrywright.plans import queries_checks, queries_counters, queries_mechanisms, queries_more, queries_movement, queries_relational, queries_rows, queries_units

Query = Callable[[SparkSession, str], DataFrame]


def _modules() -> list:
    return [queries_movement, queries_relational, queries_checks, queries_more, queries_mechanisms, queries_rows, queries_counters, queries_units]


def queries() -> dict[str, Query]:
    return {name: run for m in _modules() for name, (run, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, (_, sql) in m.QUERIES.items() if sql}
