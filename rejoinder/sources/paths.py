"""Input paths of a batch. Orders and returns each have a base of their own."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.functions.keys import file_path


def input_path(base: str, key: str) -> str:
    return f"{base.rstrip('/')}/{key}"


def literal_path(path: str) -> str:
    """A listed path as a path to read, its wildcard characters taken literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def with_input_paths(manifest: DataFrame, base_orders: str, base_returns: str) -> DataFrame:
    """Add ``orders_path`` and ``returns_path`` to rows holding the two keys."""
    return manifest.withColumns(
        {
            "orders_path": file_path(base_orders, F.col("orders_key")),
            "returns_path": file_path(base_returns, F.col("returns_key")),
        }
    )


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system names it: with scheme, without dots and doubled slashes."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def holds_files_of(spark: SparkSession, output: str, given: str) -> bool:
    """Whether any file that ``given`` (a file, folder or pattern) stands for lies at or below ``output``."""
    below = qualified(spark, output).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = files.load(given).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return not found.filter((F.col("path") == below) | F.col("path").startswith(below + "/")).isEmpty()
