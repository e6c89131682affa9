"""Queries of the engine over the test tables, with the SQL that gives the same results."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewright.queries import alignment, knowledge, problems, service, structure

MODULES = [problems, structure, knowledge, alignment, service]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries outside the optional subpackage."""
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}


def ship(spark: SparkSession) -> None:
    """Give the package to Python workers once per session; local workers import it from the same folder."""
    context = spark.sparkContext
    if getattr(context, "_tracewright_shipped", False):
        return
    context._tracewright_shipped = True
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="tracewright-zip-")
    archive = shutil.make_archive(os.path.join(folder, "tracewright_pkg"), "zip", root, "tracewright")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(archive)
