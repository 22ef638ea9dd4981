"""Spreading the rows of very frequent keys over many tasks.

AQE splits a skewed left side of a left, semi or anti join at run time, but never the
right side of a left join, and nothing behind an aggregation. For those, the frequent
keys are counted first: ``scatter`` then sends each row of such a key to one of several
salts, ``replicate`` copies the rows of the other side to all of them, and the join takes
the salt as a second key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.session import scratch_dir

SALT = "__salt"
SALTS = "__salts"

ROWS_PER_TASK = 250_000
LISTED = 1 << 15

# A sketch is sure to list what is above a LISTED-th of a task's rows if it tracks seven
# times as many keys; it takes a power of two.
_TRACKED_PER_LISTED = 8

_SKEWED = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"

#: One key column or several that are a key together.
Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])


def may_be_skewed(df: DataFrame) -> bool:
    """Whether ``df`` is estimated larger than one partition that AQE would call skewed.

    Below that, all rows on one key would still be no skewed partition; and what is small
    enough to be broadcast is not shuffled at all.
    """
    spark = df.sparkSession
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate > max(_bytes(spark, _SKEWED), _bytes(spark, _BROADCAST))


def _bytes(spark: SparkSession, name: str) -> int:
    given = spark.conf.get(name)
    return -1 if given.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)


def aqe_splits(spark: SparkSession) -> bool:
    """Whether AQE is there to split skewed partitions of a join."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(name).lower() == "true" for name in names)


def heavy_hitters(df: DataFrame, key: Key) -> DataFrame:
    """``task, rows, found``: for every task its rows with a key, and the hashes of keys that are
    frequent there with the most rows they can have.

    Frequent items are summed up within the task, in bounded memory, so what is sent does
    not grow with the number of distinct keys. Any key above a ``LISTED``-th of a task's
    rows is in its list.
    """
    columns = key_columns(key)
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("hash")
    rows = df.filter(_all_known(columns)).select(F.spark_partition_id().alias("task"), hashed)
    top = F.expr(f"approx_top_k(hash, {LISTED}, {_TRACKED_PER_LISTED * LISTED})")
    return rows.groupBy("task").agg(F.count(F.lit(1)).alias("rows"), top.alias("found"))


def hot_keys(df: DataFrame, key: Key, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """The keys with more than ``rows_per_task`` rows, as a table of the key and ``__salts``, or none.

    A key that is frequent in the whole has the same share of the rows of at least one task, so the
    lists of the tasks hold every such key; only what they hold is counted exactly. Keys are compared as the join
    compares them, so all types are covered. The list is written, since it is used on both
    sides. Its size has a proven bound: where ``rows_per_task`` is less than a ``LISTED``-th
    of all rows, only keys above that share need salts to keep tasks even, and there are
    fewer than ``LISTED`` of these.
    """
    columns = key_columns(key)
    tasks = _written(heavy_hitters(df, columns), "heavy-hitters")
    rows = tasks.agg(F.sum("rows")).first()[0] or 0
    least = max(rows_per_task, rows // LISTED)
    if rows <= least:
        return None
    share = F.col("rows") * F.lit(least / rows)
    listed = tasks.select(F.explode(F.filter("found", lambda x: x["count"] >= F.floor(share))).alias("x"))
    listed = _written(listed.select(F.col("x.item").alias("__hash")).distinct(), "listed-keys")
    if listed.isEmpty():
        return None
    known = df.select(*[F.col(f"`{c}`") for c in columns]).filter(_all_known(columns))
    hashed = known.withColumn("__hash", F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    counts = hashed.join(listed, "__hash", "left_semi").groupBy(*[f"`{c}`" for c in columns]).agg(F.count(F.lit(1)).alias("__rows"))
    hot = counts.filter(F.col("__rows") > least)
    hot = _written(hot.select(*[f"`{c}`" for c in columns], F.ceil(F.col("__rows") / least).cast("int").alias(SALTS)), "hot-keys")
    return None if hot.isEmpty() else hot


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scatter(df: DataFrame, key: Key, hot: DataFrame | None, salt: str = SALT) -> DataFrame:
    """Add ``salt``: rows of a hot key go round its salts, all others get 0.

    The salt follows the position of a row in its partition, so exact copies are
    spread too. Use it on what comes from a scan, before any shuffle: a task that
    is run again over the same files then repeats it.
    """
    if hot is None:
        return df
    position = F.pmod(F.monotonically_increasing_id(), F.col(SALTS)).cast("int")
    return _with_salts(df, key, hot).withColumn(salt, position).drop(SALTS)


def replicate(df: DataFrame, key: Key, hot: DataFrame | None, salt: str = SALT) -> DataFrame:
    """Add ``__salts`` and ``salt``: rows of a hot key once per salt, all others
    once with salt 0."""
    if hot is None:
        return df
    every = F.explode(F.sequence(F.lit(0), F.col(SALTS) - 1))
    return _with_salts(df, key, hot).withColumn(salt, every)


def join_keys(key: Key, hot: DataFrame | None, salt: str = SALT) -> list[str]:
    """The columns to join on: the salt is there only if a key is hot."""
    return key_columns(key) + ([] if hot is None else [salt])


def _with_salts(df: DataFrame, key: Key, hot: DataFrame) -> DataFrame:
    # Fewer than LISTED rows, see hot_keys, so the broadcast cannot grow with the data.
    columns = key_columns(key)
    renamed = [F.col(f"`{name}`").alias(f"__hot{i}") for i, name in enumerate(hot.columns[: len(columns)])]
    own = F.broadcast(hot.select(*renamed, F.col(SALTS).alias("__found")))
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`") == F.col(f"__hot{i}") for i, c in enumerate(columns)])
    found = df.join(own, same, "left").withColumn(SALTS, F.coalesce("__found", F.lit(1)))
    return found.drop("__found", *[f"__hot{i}" for i in range(len(columns))])
