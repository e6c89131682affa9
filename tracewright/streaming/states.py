"""The life of a package as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tracewright.streaming.windows import run

#: What may follow a status; a terminal one is left only by being queued again.
NEXT = {"queued": {"generating", "failed"}, "generating": {"reflecting", "failed", "no_rule"}, "reflecting": {"parsing", "failed"}, "parsing": {"success", "failed"}, "success": {"queued"}, "failed": {"queued"}, "no_rule": {"queued"}}


def _step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    status, attempts, refused = state.get if state.exists else ("", 0, 0)
    rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
    for new in rows["status"]:
        if (status == "" and new == "queued") or new in NEXT.get(status, ()):
            attempts += new == "queued"
            status = new
        else:
            refused += 1
    state.update((status, attempts, refused))
    yield pd.DataFrame([(key[0], status, attempts, refused)], columns=["package_id", "status", "attempts", "refused"])


def package_states(spark: SparkSession, path: str) -> DataFrame:
    """(package_id, status, attempts, refused) after a stream of (package_id, seq, status) events.

    An event that may not follow the present status is refused and counted. State is kept per package, so a key holds three
    values however many events it had; every batch emits the keys it touched, and the last one of a key stands.
    """

    def build(events: DataFrame) -> DataFrame:
        return events.groupBy("package_id").applyInPandasWithState(_step, "package_id string, status string, attempts int, refused int", "status string, attempts int, refused int", "append", GroupStateTimeout.NoTimeout)

    return run(spark, path, build, "append")
