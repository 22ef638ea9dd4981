"""The list of files that have landed in a dataset, beside its rows.

Every micro-batch adds one small file to it. So that a batch has not to read as many as there
were batches before, ``FAN`` of them become one of the next level, sorted by key, ``FAN`` of those one
of the level after that, and so on: there are fewer than ``FAN`` of each level, and every key is
rewritten once a level. A batch asks for keys between its first and its last only. Landing keys begin
with a time, and Parquet keeps the least and greatest key of every row group, so what landed at other
times is passed over unread.

The list is a set: a key may stand in it twice, as it does when a merge dies before what
it has merged is deleted, and the next merge takes copies together.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANDING_KEY = "landing_key"
LEDGER = "_landed"
FAN = 16

_SCHEMA = f"{LANDING_KEY} string, folder string"
_MERGED = re.compile(r"merged=(\d+)-[0-9a-f]+")


def _place(target: str) -> str:
    return f"{target.rstrip('/')}/{LEDGER}"


def _read(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).parquet(*paths)


def landed_files(spark: SparkSession, target: str, between: tuple[str, str] | None = None) -> DataFrame:
    """``landing_key, folder`` of every file that lies below ``target``, of those with
    keys ``between`` two, if given."""
    try:
        known = _read(spark, _place(target))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], _SCHEMA)
    return known.filter(F.col(LANDING_KEY).between(*between)) if between else known


def add_landed(spark: SparkSession, target: str, folder: str, keys: Iterable[str], fan: int = FAN) -> None:
    """Put the files of one micro-batch, at most ``max_files``, on the list, in place of what it had there."""
    listed = spark.createDataFrame([(key, folder) for key in keys], _SCHEMA)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{_place(target)}/{folder}")
    merge_levels(spark, target, fan)


def merge_levels(spark: SparkSession, target: str, fan: int = FAN) -> None:
    """Merge levels that are full, from the lowest on."""
    ledger = spark._jvm.org.apache.hadoop.fs.Path(_place(target))
    system = ledger.getFileSystem(spark._jsc.hadoopConfiguration())
    levels: dict[int, list[str]] = defaultdict(list)
    for status in system.listStatus(ledger):  # fewer than ``fan`` of each level, but for what just came
        name = status.getPath().getName()
        merged = _MERGED.fullmatch(name)
        if merged or name.startswith("batch_id="):
            levels[int(merged[1]) if merged else 0].append(name)
    level = 0
    while len(levels[level]) >= fan:
        full = [f"{_place(target)}/{name}" for name in sorted(levels[level])]
        name = f"merged={level + 1}-{uuid.uuid4().hex}"
        rows = _read(spark, *full).distinct().repartitionByRange(LANDING_KEY).sortWithinPartitions(LANDING_KEY)
        rows.write.mode("errorifexists").parquet(f"{_place(target)}/{name}")
        for path in full:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
        level += 1
        levels[level].append(name)
