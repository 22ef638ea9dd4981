"""Batches started by arrivals instead of by a call."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rejoinder.operators.gates import InputError
from rejoinder.plans.arrivals import Pair, names_in_order, pairs_of, run_pairs
from rejoinder.plans.batch import run_batch
from rejoinder.sources.paths import literal_path
from rejoinder.streaming.landing import file_names

log = logging.getLogger(__name__)

_WAITING = "kind string, path string"
_RUNS = "pair string, orders string, returns string, error string"
_TOGETHER = frozenset("order_types return_types date_format trim_keys at rows_per_task".split())


def run_on_arrival(
    spark: SparkSession,
    orders_folder: str,
    returns_folder: str,
    output_path: str,
    checkpoint: str,
    pattern: str = "*.csv",
    **batch,
) -> StreamingQuery:
    """Run a batch on every pair of an orders and a returns file that arrive.

    Files lie there under their landing keys. In the order of their names the first
    orders file belongs to the first returns file, and so on; a file without a partner waits
    for the next arrival. Each pair has a result of its own, ``pair=<orders file>`` below
    ``output_path``, so the results can be read as one dataset. A pair whose input fails its
    checks leaves none; ``runs`` lists every pair with its error, if any. Other failures stop
    the query, and starting it again repeats its last pairs, whose results are replaced.

    The pairs of a micro-batch are one plan, see ``run_pairs``. ``batch`` goes to
    ``run_batch``; with options that only a pair by itself can follow (inferred types, line
    breaks in fields, a table, rejected rows) the pairs are run one by one.
    """
    state = checkpoint.rstrip("/")
    together = {name: value for name, value in batch.items() if name in _TOGETHER}
    plain = all(
        name in _TOGETHER or value == {"mode": "declared", "multi_line": False}.get(name) for name, value in batch.items()
    )

    def run(new_files: DataFrame, batch_id: int) -> None:
        session = new_files.sparkSession
        new = [(row.kind, row.path) for row in new_files.select("kind", "path").collect()]  # one micro-batch
        files = [*new, *_waiting(session, state, batch_id - 1)]
        orders, returns = ([path for kind, path in files if kind == wanted] for wanted in ("orders", "returns"))
        pairs = list(pairs_of(orders, returns))
        if plain:
            errors = run_pairs(session, pairs, output_path, **together)
        else:
            errors = _one_by_one(session, pairs, output_path, batch)
        runs = [(*pair, errors[pair.name]) for pair in pairs]
        rest = [
            (kind, path) for kind, paths in (("orders", orders), ("returns", returns)) for path in names_in_order(paths)[len(pairs) :]
        ]
        for name, rows, schema in (("runs", runs, _RUNS), ("waiting", rest, _WAITING)):
            table = session.createDataFrame(rows, schema).coalesce(1)
            table.write.mode("overwrite").parquet(f"{state}/{name}/batch={batch_id}")

    arrivals = file_names(spark, orders_folder, pattern).withColumn("kind", F.lit("orders")).unionAll(
        file_names(spark, returns_folder, pattern).withColumn("kind", F.lit("returns"))
    )
    return (
        arrivals.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{state}/stream")
        .trigger(availableNow=True)
        .start()
    )


def _one_by_one(spark: SparkSession, pairs: Sequence[Pair], output_path: str, batch: dict) -> dict[str, str | None]:
    errors: dict[str, str | None] = {}
    for pair in pairs:
        try:
            result = f"{output_path.rstrip('/')}/pair={pair.name}"
            run_batch(spark, literal_path(pair.orders), literal_path(pair.returns), result, **batch)
            errors[pair.name] = None
        except InputError as refused:
            errors[pair.name] = str(refused)
            log.error("pair %s: %s", pair.name, refused)
    return errors


def runs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``pair, orders, returns, error, batch`` of every pair that was run or refused."""
    return spark.read.schema(f"{_RUNS}, batch long").parquet(f"{checkpoint.rstrip('/')}/runs")


def _waiting(spark: SparkSession, state: str, batch_id: int) -> list[tuple[str, str]]:
    """The files that had no partner after a batch."""
    try:
        found = spark.read.schema(_WAITING).parquet(f"{state}/waiting/batch={batch_id}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [(row.kind, row.path) for row in found]

