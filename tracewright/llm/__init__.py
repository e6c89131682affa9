"""Operators for training data. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm import catalog as _catalog


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of the subpackage."""
    return dict(_catalog.QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL by query name, where SQL can express the query."""
    return dict(_catalog.SQL)
