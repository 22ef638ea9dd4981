"""New landing keys against the ones already there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.operators.skew import (
    ROWS_PER_TASK,
    SALTS,
    hot_keys,
    join_keys,
    may_be_skewed,
    replicate,
    scatter,
)


def accepted_keys(
    new: DataFrame, existing: DataFrame, key: str = "key", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows of ``new`` whose key is not there yet, null keys included."""
    # Null keys match nothing. They stay out of the join, which would send them
    # all to one task.
    null = F.col(f"`{key}`").isNull()
    unknown = _compare(new.filter(~null), existing, key, "left_anti", rows_per_task)
    return unknown.unionAll(new.filter(null))


def refused_keys(
    new: DataFrame, existing: DataFrame, key: str = "key", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows of ``new`` whose key is already there."""
    return _compare(new, existing, key, "left_semi", rows_per_task)


def _compare(
    new: DataFrame, existing: DataFrame, key: str, how: str, rows_per_task: int
) -> DataFrame:
    # Copies of an existing key collapse before the shuffle, and the join reuses
    # the partitioning of that aggregation.
    known = existing.select(f"`{key}`").distinct()
    hot = hot_keys(new, key, rows_per_task) if may_be_skewed(new) else None
    known = replicate(known, key, hot).drop(SALTS)
    found = scatter(new, key, hot).join(known, on=join_keys(key, hot), how=how)
    return found.select(*[F.col(f"`{name}`") for name in new.columns])
