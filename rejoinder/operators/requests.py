"""Batch requests against the files that have arrived.

A manifest holds one request per row: ``batch, orders_key, returns_key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.functions import fixed
from rejoinder.functions.keys import file_path, is_blank
from rejoinder.operators.skew import (
    ROWS_PER_TASK,
    SALT,
    SALTS,
    hot_keys,
    join_keys,
    may_be_skewed,
    replicate,
    scatter,
)

BAD_REQUEST, NOT_FOUND, OK, ERROR = 400, 404, 200, 500


def is_bad_request() -> Column:
    """A request that lacks one of its keys."""
    return is_blank(F.col("orders_key")) | is_blank(F.col("returns_key"))


def check_requests(
    manifest: DataFrame,
    listing: DataFrame,
    orders_bucket: str,
    returns_bucket: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``status_code`` and ``missing_files`` to every request.

    400 where a key is missing, else 404 where a file is, else 200. ``listing``
    has ``bucket, key``. Missing files are named ``bucket/key``, orders first.
    """
    bad = is_bad_request()
    files = manifest.withColumns(
        {
            "__orders": _lookup(bad, "orders_key"),
            "__returns": _lookup(bad, "returns_key"),
        }
    )
    arrived = {
        "__orders": _arrived(listing, orders_bucket, "__orders"),
        "__returns": _arrived(listing, returns_bucket, "__returns"),
    }
    # Both salts are set before the first join shuffles the rows.
    large = may_be_skewed(manifest)
    hot = {name: hot_keys(files, name, rows_per_task) if large else None for name in arrived}
    for name in arrived:
        files = scatter(files, name, hot[name], name + SALT)
    for name, known in arrived.items():
        known = replicate(known, name, hot[name], name + SALT).drop(SALTS)
        files = files.join(known, on=join_keys(name, hot[name], name + SALT), how="left")
    no_orders, no_returns = (F.col(f"{name}_arrived").isNull() for name in arrived)
    orders_file = file_path(orders_bucket, F.col("orders_key"))
    returns_file = file_path(returns_bucket, F.col("returns_key"))
    missing = (
        F.when(~bad & no_orders & no_returns, F.array(orders_file, returns_file))
        .when(~bad & no_orders, F.array(orders_file))
        .when(~bad & no_returns, F.array(returns_file))
        .otherwise(F.array().cast("array<string>"))
    )
    return (
        files.withColumn("missing_files", missing)
        .withColumn(
            "status_code",
            F.when(bad, BAD_REQUEST).when(F.size("missing_files") > 0, NOT_FOUND).otherwise(OK),
        )
        .select(*manifest.columns, "status_code", "missing_files")
    )


def _lookup(bad: Column, key: str) -> Column:
    # What a bad request looks up does not count. It differs from row to row, since
    # equal names, or nulls, would all be sent to one task.
    anything = F.concat_ws("/", "batch", "orders_key", "returns_key")
    return F.when(bad, anything).otherwise(F.col(key))


def _arrived(listing: DataFrame, bucket: str, column: str) -> DataFrame:
    names = listing.filter(F.col("bucket") == bucket).select(F.col("key").alias(column))
    return names.distinct().withColumn(f"{column}_arrived", F.lit(True))


def encode_outcome(
    outcome: DataFrame, execution_id: str = "batch", execution_at: float | None = None
) -> DataFrame:
    """Add ``message`` and ``answer``, the JSON document ``{statusCode, body}`` whose
    body is JSON text again. ``execution_id`` names the column that identifies a
    started run. An ``error`` column, if there is one, turns a 200 into a 500."""
    code = F.col("status_code")
    if "error" in outcome.columns:
        code = F.when((code == OK) & F.col("error").isNotNull(), ERROR).otherwise(code)
        error = F.col("error")
    else:
        error = F.lit(None).cast("string")
    message = (
        F.when(code == BAD_REQUEST, fixed.BAD_REQUEST_MESSAGE)
        .when(code == NOT_FOUND, fixed.MISSING_FILE_MESSAGE)
        .when(code == ERROR, fixed.START_ERROR_MESSAGE)
        .otherwise(fixed.STARTED_MESSAGE)
    )
    request = F.struct(
        F.col("orders_key").alias(fixed.REQUEST_ORDERS), F.col("returns_key").alias(fixed.REQUEST_RETURNS)
    )
    started = F.struct(
        "message",
        F.col(execution_id).alias(fixed.ANSWER_EXECUTION),
        F.col("orders_key").alias(fixed.ANSWER_ORDERS),
        F.col("returns_key").alias(fixed.ANSWER_RETURNS),
        F.lit(execution_at).cast("double").alias(fixed.ANSWER_TIME),
    )
    body = (
        F.when(code == BAD_REQUEST, F.to_json(F.struct("message", request.alias(fixed.ANSWER_INPUT))))
        .when(code == NOT_FOUND, F.to_json(F.struct("message", F.col("missing_files").alias(fixed.ANSWER_MISSING))))
        .when(code == ERROR, F.to_json(F.struct("message", error.alias("error"))))
        .otherwise(F.to_json(started))
    )
    answer = F.to_json(F.struct(F.col("status_code").alias(fixed.ANSWER_CODE), body.alias(fixed.ANSWER_BODY)))
    return outcome.withColumns({"status_code": code, "message": message}).withColumn("answer", answer)
