"""Column functions over the state of a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rejoinder.functions import fixed


def is_terminal(state: Column) -> Column:
    """Whether a run is over; an unknown or absent state is not."""
    return F.coalesce(state.isin(*fixed.TERMINAL_STATES), F.lit(False))


def route(state: Column) -> Column:
    """What follows a state check. Only two states end the wait, so a run that
    timed out or was aborted keeps waiting, although ``is_terminal`` holds."""
    return (
        F.when(state == fixed.SUCCEEDED, "success")
        .when(state == fixed.FAILED, "failure")
        .otherwise("wait")
    )


def notice_subject(state: Column) -> Column:
    """Subject of the notice a state check sends; null while waiting."""
    return F.when(state == fixed.SUCCEEDED, fixed.SUCCESS_SUBJECT).when(
        state == fixed.FAILED, fixed.FAILURE_SUBJECT
    )


def notice_message(state: Column, orders_key: Column, returns_key: Column) -> Column:
    """Text of the notice a state check sends; null while waiting."""
    start, between, end = fixed.SUCCESS_MESSAGE.split("{}")
    success = F.concat(
        F.lit(start),
        F.coalesce(orders_key, F.lit("null")),
        F.lit(between),
        F.coalesce(returns_key, F.lit("null")),
        F.lit(end),
    )
    return F.when(state == fixed.SUCCEEDED, success).when(
        state == fixed.FAILED, fixed.FAILURE_MESSAGE
    )
