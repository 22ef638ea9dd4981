"""A manifest of requests from check to answer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rejoinder.operators.requests import OK, check_requests, encode_outcome
from rejoinder.operators.skew import ROWS_PER_TASK
from rejoinder.sources.paths import with_input_paths


def answer_requests(
    manifest: DataFrame,
    listing: DataFrame,
    orders_bucket: str,
    returns_bucket: str,
    execution_at: float | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every request with its status code, missing files and JSON answer."""
    outcome = check_requests(manifest, listing, orders_bucket, returns_bucket, rows_per_task)
    return encode_outcome(outcome, execution_at=execution_at)


def accepted_batches(answers: DataFrame, base_orders: str, base_returns: str) -> DataFrame:
    """The requests that may run, with their input paths."""
    return with_input_paths(answers.filter(answers.status_code == OK), base_orders, base_returns)
