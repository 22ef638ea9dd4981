"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings a job of this package relies on. AQE coalesces small shuffle
# partitions, splits a skewed left side of the join and turns a sort-merge join
# into a broadcast join once the measured size of the returns allows it. The
# checksums make Spark run a stage again as a whole where a repeated task sent
# other rows than before, which no mixture of old and new rows survives.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
    "spark.ui.enabled": "false",
}

_local_scratch: dict[str, str] = {}
_made: list[str] = []


def build_session(app_name: str = "rejoinder", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether the executors are threads of the driver process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder of its
    own; on a cluster that would be invisible to the other machines, so the
    setting is required there.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not is_local(spark):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="rejoinder-")
        base = _local_scratch[app]
    path = f"{base.rstrip('/')}/rejoinder/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def scratch_made() -> list[str]:
    """The scratch folders of this process that are still there, oldest first."""
    return list(_made)


def forget_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch folders, all that this process has made unless ``paths`` are given.

    Results that read from them are of no use afterwards, so without ``paths`` call it at
    the end of a session.
    """
    for path in scratch_made() if paths is None else paths:
        if path in _made:
            _made.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
