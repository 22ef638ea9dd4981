"""What the operators share: written intermediate tables and columns of text as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from rejoinder.session import forget_scratch, scratch_dir

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARKS_OWN = 64 << 20


def bound_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Hands texts to Python in batches of about ``limit`` bytes, unless the session has a limit of its own.

    A batch is held several times over, on both sides of the pipe and by every task at
    once; whole texts of any length still come in one row.
    """
    given = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES))
    if given == _SPARKS_OWN:
        spark.conf.set(BATCH_BYTES, f"{limit}b")


def saved(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs the tasks that read the table, not the
    work that made it, and no later stage makes it again.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.options(compression="zstd", **options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read any more."""
    for table in tables:
        forget_scratch(table.sparkSession, [table.scratch_path])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of bytes, and where each begins (one entry more)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes of text each, or a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)
