"""Files that arrive, taken once each.

The checkpoint of the stream remembers which files were taken, so a query started
again on it adds only what arrived since. A list beside the rows remembers it too, for the
case that the checkpoint is lost.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from rejoinder.functions.fixed import DATE_FORMAT
from rejoinder.functions.keys import landing_key
from rejoinder.operators.landing import accepted_keys
from rejoinder.sources.csv import (
    cast_columns,
    is_header_mismatch,
    present,
    scan_csv_by_header,
    scan_named,
    scan_text,
)
from rejoinder.sources.paths import literal_path
from rejoinder.streaming.ledger import LANDING_KEY, add_landed, landed_files

# By default a stream passes over files a week older than the newest it has seen,
# such as copies that kept their times. Here none is passed over; the price is that
# the driver remembers the name of every file taken.
_MAX_FILE_AGE = "36500d"

_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def file_names(
    spark: SparkSession, folder: str, pattern: str = "*.csv", max_files: int = 10_000
) -> DataFrame:
    """A stream of the ``path`` and ``modificationTime`` of new files. The content column
    is not selected, so no file is opened."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", _MAX_FILE_AGE)
        .load(folder)
        .select("path", "modificationTime")
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What tells the streams of different checkpoints apart."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def land_rows(
    spark: SparkSession,
    arrivals: str,
    columns: Sequence[str],
    target: str,
    checkpoint: str,
    types: Mapping[str, str] | None = None,
    date_format: str = DATE_FORMAT,
    pattern: str = "*.csv",
    max_files: int = 10_000,
) -> StreamingQuery:
    """Add the rows of new CSV files below ``arrivals`` to the Parquet dataset ``target``,
    once each, with the ``landing_key`` of their file.

    All files must have the header ``columns``; one that has another stops the
    query. Runs through what is there and ends.
    """

    def read(session: SparkSession, paths: list[str]) -> DataFrame:
        return scan_named(session, paths, list(columns), False, True, _file_key())

    return _land(spark, arrivals, target, checkpoint, [(read, types, date_format)], pattern, max_files)


def land_files(
    spark: SparkSession,
    arrivals: str,
    target: str,
    checkpoint: str,
    types: Mapping[str, str] | None = None,
    date_format: str = DATE_FORMAT,
    pattern: str = "*.csv",
    max_files: int = 1_000,
) -> StreamingQuery:
    """Like ``land_rows`` for files whose headers differ in order or columns.

    A micro-batch is read as files of one header first, and only if one of them has
    another, header by header.
    """

    def alike(session: SparkSession, paths: list[str]) -> DataFrame:
        return scan_text(session, paths, extra=_file_key())

    def by_header(session: SparkSession, paths: list[str]) -> DataFrame:
        return scan_csv_by_header(session, paths, extra=_file_key())

    ways = [(alike, types, date_format), (by_header, types, date_format)]
    return _land(spark, arrivals, target, checkpoint, ways, pattern, max_files)


def _file_key() -> dict[str, Column]:
    return {LANDING_KEY: landing_key(F.col("_metadata.file_modification_time"), F.col("_metadata.file_name"))}


def _land(
    spark: SparkSession,
    arrivals: str,
    target: str,
    checkpoint: str,
    ways: Sequence[tuple[Callable[[SparkSession, list[str]], DataFrame], Mapping[str, str] | None, str]],
    pattern: str,
    max_files: int,
) -> StreamingQuery:
    """The stream carries names. Each micro-batch replaces its own folder below ``target``,
    named after the stream and the batch, so a batch that is run again leaves no copies.

    Beside the rows lies a list of the files landed (``ledger``), which readers of ``target`` pass over.
    A stream that starts anew after its checkpoint was lost meets all files again; those on
    the list in another folder are refused.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = F.element_at(F.split("path", "/"), -1)
        folder = f"batch_id={stream_id(session, checkpoint)}-{batch_id}"
        files = batch.select("path", landing_key(F.col("modificationTime"), name).alias(LANDING_KEY))
        ends = files.agg(F.min(LANDING_KEY), F.max(LANDING_KEY)).first()
        if ends[0] is None:
            return
        known = landed_files(session, target, tuple(ends)).filter(F.col("folder") != folder)
        new = accepted_keys(files, known, LANDING_KEY).collect()  # at most max_files
        if not new:
            return
        paths = [literal_path(row.path) for row in new]
        for (read, types, date_format), last in zip(ways, [False] * (len(ways) - 1) + [True]):
            try:
                text = read(session, paths)
                _replace(cast_columns(text, present(types, text), date_format), f"{target.rstrip('/')}/{folder}")
                break
            except Exception as error:
                if last or not is_header_mismatch(error):
                    raise
        add_landed(session, target, folder, [row[LANDING_KEY] for row in new])

    return (
        file_names(spark, arrivals, pattern, max_files)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _replace(rows: DataFrame, folder: str) -> None:
    if rows.columns:
        rows.write.mode("overwrite").parquet(folder)
