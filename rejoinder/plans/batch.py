"""The batch job: two CSV inputs in, one Parquet dataset and one table out."""

from __future__ import annotations

import fnmatch
import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import SparkSession

from rejoinder.functions.fixed import DATE_FORMAT
from rejoinder.operators.enrich import enrich, run_time, trimmed_keys
from rejoinder.operators.gates import InputError, require_columns, require_distinct_columns, require_rows
from rejoinder.operators.skew import ROWS_PER_TASK
from rejoinder.sinks.snapshots import write_snapshot
from rejoinder.sinks.staging import can_stage
from rejoinder.sinks.tables import write_jdbc, write_parquet
from rejoinder.sources.csv import rejected_rows, scan_csv, scan_text
from rejoinder.sources.paths import holds_files_of

log = logging.getLogger(__name__)


@dataclass
class BatchResult:
    """What a run wrote. The Parquet dataset is replaced before the table, so a
    failing table leaves a new dataset beside an old or missing table."""

    output_path: str
    updated_on: datetime
    columns: list[str] = field(default_factory=list)
    jdbc_table: str | None = None
    jdbc_error: str | None = None

    @property
    def succeeded(self) -> bool:
        return self.jdbc_error is None


def run_batch(
    spark: SparkSession,
    orders_path: str,
    returns_path: str,
    output_path: str,
    jdbc: Mapping[str, object] | None = None,
    mode: str = "declared",
    order_types: Mapping[str, str] | None = None,
    return_types: Mapping[str, str] | None = None,
    date_format: str = DATE_FORMAT,
    multi_line: bool = False,
    trim_keys: bool = False,
    rejects_path: str | None = None,
    at: datetime | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    snapshots: bool = False,
) -> BatchResult:
    """Scan, check, join, stamp, replace the dataset, replace the table.

    ``jdbc`` holds the arguments of ``write_jdbc`` (``url``, ``table``, ...) and
    may be left out. The table is fed from the written dataset: the join runs once
    and both sinks hold the same rows and the same time. Where the database is one that
    ``write_jdbc`` can stage for, the table is replaced in one step; else its rows are
    counted, and it is written again where they are not all there once.

    Values that do not fit ``order_types`` or ``return_types`` become null in the
    result; with ``rejects_path`` the rows concerned are also kept there as text, in
    ``orders`` and ``returns``. ``trim_keys`` takes the blanks off keys, so that a
    blank key is none. With ``snapshots`` the dataset is replaced in one step and
    ``read_parquet_result`` finds it, see ``write_snapshot``; else its files are replaced in place.
    """
    outputs = [output_path] + ([rejects_path] if rejects_path else [])
    for output in outputs:
        for path in (orders_path, returns_path):
            if overlaps(output, path) or holds_files_of(spark, output, path):
                raise InputError(f"output {output} would overwrite input {path}")
    if rejects_path and overlaps(rejects_path, output_path):
        raise InputError(f"rejects {rejects_path} and output {output_path} overlap")

    def scan(path: str, types: Mapping[str, str] | None):
        return scan_csv(spark, path, mode, types, date_format, multi_line)

    orders, returns = scan(orders_path, order_types), scan(returns_path, return_types)
    require_rows(orders=orders, returns=returns)
    require_columns(orders=orders, returns=returns)
    require_distinct_columns(orders, returns)
    if trim_keys:
        orders, returns = trimmed_keys(orders), trimmed_keys(returns)

    result = BatchResult(output_path, at or run_time())
    joined = enrich(orders, returns, result.updated_on, rows_per_task)
    result.columns = joined.columns
    stored = output_path
    if snapshots:
        stored = write_snapshot(joined, output_path)
    else:
        write_parquet(joined, output_path)
    log.info("replaced dataset %s", output_path)
    if rejects_path:
        given = (("orders", orders_path, order_types), ("returns", returns_path, return_types))
        for name, path, types in given:
            text = scan_text(spark, path, multi_line)
            write_parquet(rejected_rows(text, types or {}, date_format), f"{rejects_path}/{name}")

    if jdbc:
        result.jdbc_table = str(jdbc["table"])
        try:
            write_jdbc(spark.read.parquet(stored), **{"attempts": 3, "staged": can_stage(str(jdbc["url"])), **jdbc})
            log.info("replaced table %s", result.jdbc_table)
        except Exception as error:  # any driver may fail in its own way
            log.error("table %s was not replaced: %s", result.jdbc_table, error)
            result.jdbc_error = str(error)
    return result


def overlaps(output: str, given: str) -> bool:
    """Whether one path is, contains or matches the other, as far as their names tell."""
    out, source = _plain(output), _plain(given)
    return (
        out == source
        or out.startswith(source + "/")
        or source.startswith(out + "/")
        or fnmatch.fnmatchcase(out, source)
    )


def _plain(path: str) -> str:
    """The path without its scheme and doubled or final slashes."""
    return "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", path).strip("/").replace("//", "/")
