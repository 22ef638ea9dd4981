"""Many pairs of files as one plan."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.functions.fixed import DATE_FORMAT, ORDER_KEY
from rejoinder.operators.enrich import drop_null_keys, join_spread, run_time, stamp, trimmed_keys
from rejoinder.operators.gates import InputError, require_columns, require_distinct_columns
from rejoinder.operators.skew import ROWS_PER_TASK, hot_keys, may_be_skewed
from rejoinder.plans.batch import overlaps
from rejoinder.sources.csv import cast_columns, file_headers, header_names, listed_path, scan_named
from rejoinder.sources.paths import holds_files_of, literal_path

log = logging.getLogger(__name__)

PAIR = "pair"
_FILE = "__file"
_MAPPED = "__mapped"


class Pair(NamedTuple):
    """A pair of listed files; ``name`` is the orders file's."""

    name: str
    orders: str
    returns: str


def run_pairs(
    spark: SparkSession,
    pairs: Sequence[Pair],
    output_path: str,
    order_types: Mapping[str, str] | None = None,
    return_types: Mapping[str, str] | None = None,
    date_format: str = DATE_FORMAT,
    trim_keys: bool = False,
    at: datetime | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[str, str | None]:
    """``run_batch`` for all ``pairs`` at once; returns the error of each pair by its name, or none.

    One pass over the files finds their headers and those without rows. Pairs whose files
    have the same headers are then one scan of orders and one of returns, each row tagged with
    its pair by the file it lies in, one join on pair and key, and one write, which replaces
    the partitions ``pair=<name>`` below ``output_path`` and no others. The number of jobs
    follows the number of different headers, not that of pairs. A pair that is refused does
    not stop the others; a pair none of whose orders has a key leaves no partition.
    """
    for pair in pairs:
        for path in (pair.orders, pair.returns):
            if overlaps(output_path, path):
                raise InputError(f"output {output_path} would overwrite input {path}")
    files = [literal_path(path) for pair in pairs for path in (pair.orders, pair.returns)]
    if not files:
        return {}
    if holds_files_of(spark, output_path, files):
        raise InputError(f"output {output_path} would overwrite an input")
    known = {row.path: row for row in file_headers(spark, files).collect()}  # one row per file of a micro-batch
    names: dict[int, list[str]] = {}
    for path, row in known.items():
        if row.header not in names:
            names[row.header] = header_names(spark, literal_path(path))

    errors: dict[str, str | None] = {}
    alike: dict[tuple[int, int, int], list[Pair]] = {}
    seen: dict[str, int] = {}
    for pair in pairs:
        empty = [kind for kind, path in (("orders", pair.orders), ("returns", pair.returns)) if path not in known or not known[path].has_rows]
        if empty:
            errors[pair.name] = f"no rows in: {', '.join(empty)}"
            continue
        # Files of one name in several folders: the last one's result stays, as if run one after another.
        turn = seen[pair.name] = seen.get(pair.name, -1) + 1
        alike.setdefault((turn, known[pair.orders].header, known[pair.returns].header), []).append(pair)
    at = at or run_time()
    for (_, orders_header, returns_header), group in sorted(alike.items(), key=lambda x: x[0]):
        try:
            orders = _side(spark, [(p.orders, p.name) for p in group], names[orders_header], order_types, date_format)
            returns = _side(spark, [(p.returns, p.name) for p in group], names[returns_header], return_types, date_format)
            joined = _joined(orders, returns, trim_keys, rows_per_task)
        except InputError as refused:
            errors |= {p.name: str(refused) for p in group}
            log.error("%d pairs, %s first: %s", len(group), group[0].name, refused)
            continue
        # Of the rows of a pair those of one task make a file; AQE splits large pairs and merges small ones.
        result = stamp(joined, at).hint("rebalance", PAIR)
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PAIR).parquet(output_path)
        errors |= dict.fromkeys([p.name for p in group])
    return errors


class _Side(NamedTuple):
    """The rows of one kind of file: as scanned, and with their pair."""

    scanned: DataFrame
    rows: DataFrame


def _side(
    spark: SparkSession, files: Sequence[tuple[str, str]], names: Sequence[str], types: Mapping[str, str] | None, date_format: str
) -> _Side:
    taken = [name for name in names if name.lower() in (PAIR, _FILE, _MAPPED)]
    if taken:
        raise InputError(f"columns named like the partition of the result: {taken}")
    paths = [literal_path(path) for path, _ in files]
    text = scan_named(spark, paths, names, False, False)
    scanned = cast_columns(text, types or {}, date_format)
    tagged = text.withColumn(_FILE, listed_path(F.col("_metadata.file_path")))
    typed = cast_columns(tagged, types or {}, date_format)
    # One row per file of a micro-batch, so the stream's limit of files bounds the broadcast.
    pairs = F.broadcast(spark.createDataFrame(list(files), f"{_MAPPED} string, {PAIR} string"))
    rows = typed.join(pairs, F.col(_FILE) == F.col(_MAPPED)).drop(_FILE, _MAPPED)
    return _Side(scanned, rows)


def _joined(orders: _Side, returns: _Side, trim_keys: bool, rows_per_task: int) -> DataFrame:
    """Orders with their returns of the same pair; the pair comes last."""
    require_columns(orders=orders.scanned, returns=returns.scanned)
    require_distinct_columns(orders.scanned, returns.scanned)
    left, right = orders.rows, returns.rows
    if trim_keys:
        left, right = trimmed_keys(left), trimmed_keys(right)
    keys = [PAIR, ORDER_KEY]
    # The estimate of a join is the product of its sides, so the scans are asked.
    hot = hot_keys(right, keys, rows_per_task) if may_be_skewed(returns.scanned) else None
    joined = join_spread(left, right, hot, by=(PAIR,)) if hot is not None else left.join(right, on=keys, how="left")
    return drop_null_keys(joined).select(*[F.col(f"`{c}`") for c in joined.columns if c != PAIR], PAIR)


def names_in_order(paths: Sequence[str]) -> list[str]:
    return sorted(paths, key=file_name)


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def pairs_of(orders: Sequence[str], returns: Sequence[str]) -> Iterator[Pair]:
    """The first orders file by name with the first returns file, and so on."""
    for left, right in zip(names_in_order(orders), names_in_order(returns)):
        yield Pair(file_name(left), left, right)
