"""Runs, their history and their notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.functions import fixed, status

ENTERED, EXITED, FAILED = fixed.ENTERED_DETAILS, fixed.EXITED_DETAILS, fixed.FAILED_DETAILS


def _step(prefix: str, details: str, field: str) -> Column:
    # What counts is that the details are there; a null field prints as None.
    text = F.concat(F.lit(prefix), F.coalesce(F.col(f"{details}.{field}"), F.lit("None")))
    return F.when(F.col(details).isNotNull(), text)


def history_steps(events: DataFrame, keep: tuple[str, ...] = ("run", "event_id")) -> DataFrame:
    """``step`` text of every event that entered, exited or failed; other kinds
    are dropped. Details are structs, one column per kind, first present wins."""
    return events.select(
        *keep,
        F.coalesce(
            _step(fixed.ENTERED, ENTERED, "name"),
            _step(fixed.EXITED, EXITED, "name"),
            _step(fixed.FAILED_STEP, FAILED, "error"),
        ).alias("step"),
    ).filter(F.col("step").isNotNull())


def in_time_order(steps: DataFrame, run: str = "run", event_id: str = "event_id") -> DataFrame:
    """Steps by run and event. The range partitions are cut on both columns, so
    one long run is spread over many tasks."""
    return steps.orderBy(run, event_id)


def route_runs(runs: DataFrame, state: str = "status") -> DataFrame:
    """Add ``route``, ``is_terminal``, ``subject`` and ``message`` to runs that
    carry their ``orders_key`` and ``returns_key``."""
    column = F.col(state)
    return runs.withColumns(
        {
            "route": status.route(column),
            "is_terminal": status.is_terminal(column),
            "subject": status.notice_subject(column),
            "message": status.notice_message(column, F.col("orders_key"), F.col("returns_key")),
        }
    )
