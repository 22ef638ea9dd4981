"""Small facts about a result or a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.functions.fixed import PARQUET_SUFFIX
from rejoinder.functions.keys import has_suffix


def result_shape(df: DataFrame) -> DataFrame:
    """One row ``n_rows, n_cols``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def with_suffix(keys: DataFrame, suffix: str = PARQUET_SUFFIX, key: str = "key") -> DataFrame:
    """Keys that end in ``suffix``, case-sensitive."""
    return keys.filter(has_suffix(F.col(key), suffix))


def count_parts(files: DataFrame, suffix: str = PARQUET_SUFFIX, path: str = "path") -> DataFrame:
    """One row ``n_parts``: part files in a listing."""
    return with_suffix(files, suffix, path).agg(F.count(F.lit(1)).alias("n_parts"))


def latest_key(keys: DataFrame, key: str = "key", by: tuple[str, ...] = ()) -> DataFrame:
    """The last key by name, which for landing keys is the newest; per ``by``
    group if given. A partial maximum per task, no sort."""
    return keys.groupBy(*by).agg(F.max(key).alias(key))
