"""One query per operator over the given tables, each with its SQL counterpart.

A query takes ``(spark, sf_dir)``. What has to be written before it can be read
goes to ``scratch_dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.functions import keys
from rejoinder.functions.fixed import ORDER_KEY, STAMP
from rejoinder.operators import enrich as joins
from rejoinder.operators import gates, landing, runs, shape
from rejoinder.operators.skew import hot_keys
from rejoinder.plans.batch import run_batch
from rejoinder.plans.relations import joined_sql, orders, relations_sql, returns, table
from rejoinder.plans.requests import accepted_batches, answer_requests
from rejoinder.session import is_local, scratch_dir
from rejoinder.sinks.export import export_csv
from rejoinder.sinks.snapshots import write_snapshot
from rejoinder.sinks.staging import can_stage
from rejoinder.sinks.tables import write_jdbc, write_parquet
from rejoinder.sources import csv, responses
from rejoinder.sources.paths import with_input_paths
from rejoinder.sources.results import list_files, read_result
from rejoinder.streaming.landing import LANDING_KEY, land_files, land_rows
from rejoinder.streaming.trigger import run_on_arrival

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = datetime(2024, 1, 31, 12, 30, 15, 250000, tzinfo=timezone.utc)
JDBC_URL = "spark.rejoinder.jdbc.url"
JDBC_DRIVER = "spark.rejoinder.jdbc.driver"

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        if sql:
            _ORACLES[query.__name__] = sql
        return query

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# --- join, filter, stamp ---------------------------------------------------


def joined(spark: SparkSession, sf_dir: str, keyless: bool = False) -> DataFrame:
    left, right = orders(spark, sf_dir, keyless), returns(spark, sf_dir, keyless)
    return joins.drop_null_keys(joins.join_returns(left, right))


@_register(joined_sql())
def orders_returns_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: every order with its returns."""
    return joined(spark, sf_dir)


@_register(joined_sql(keyless=True))
def null_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders have no key and go; returns without one match nothing."""
    return joined(spark, sf_dir, keyless=True)


@_register(joined_sql(extra=", TIMESTAMP '2024-01-31 12:30:15.25' AS \"UpdatedOn\""))
def updated_on_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.stamp(joined(spark, sf_dir), RUN_TIME).withColumn(STAMP, _utc(STAMP))


def _utc(column: str) -> Column:
    """A time as its UTC reading, whatever the zone of the session."""
    local = F.col(column).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


@_register(
    """WITH l AS (SELECT DISTINCT o_orderpriority AS "Order ID" FROM orders),
     r AS (SELECT o_orderpriority AS "Order ID", o_orderkey AS returned FROM orders)
SELECT l."Order ID", r.returned FROM l LEFT JOIN r ON l."Order ID" = r."Order ID"
"""
)
def frequent_key_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join on a key with five values, each holding a fifth of the right
    side, which is salted over many tasks even where it could be broadcast."""
    source = table(spark, sf_dir, "orders")
    left = source.select(F.col("o_orderpriority").alias(ORDER_KEY)).distinct()
    right = source.select(F.col("o_orderpriority").alias(ORDER_KEY), F.col("o_orderkey").alias("returned"))
    hot = hot_keys(right, ORDER_KEY, rows_per_task=1_000)
    return joins.join_spread(left, right, hot)


# --- CSV in ----------------------------------------------------------------


def _csv_pair(spark: SparkSession, sf_dir: str, keyless: bool) -> tuple[str, str]:
    base = scratch_dir(spark, "csv")
    return (
        export_csv(orders(spark, sf_dir, keyless), base, "orders"),
        export_csv(returns(spark, sf_dir, keyless), base, "returns"),
    )


_BIGINT_KEYS = {ORDER_KEY: "bigint", "Customer ID": "bigint"}


def _widened(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in _BIGINT_KEYS.items()})


@_register(joined_sql(keyless=True))
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = (csv.scan_csv(spark, path, "inferred") for path in _csv_pair(spark, sf_dir, True))
    return _widened(joins.drop_null_keys(joins.join_returns(left, right)))


@_register(
    f"""{relations_sql(keyless=True)}
SELECT CAST("Order ID" AS VARCHAR) AS "Order ID", CAST("Customer ID" AS VARCHAR) AS "Customer ID", "Order Date"
FROM o"""
)
def csv_scan_blank_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files of two layouts, each with a nameless first column."""
    base = scratch_dir(spark, "csv")
    rows = orders(spark, sf_dir, keyless=True)
    pending = F.col(ORDER_KEY).isNull()
    for layout, part in (("a", rows.filter(~pending)), ("b", rows.filter(pending).select(*reversed(rows.columns)))):
        nameless = part.select(F.lit(0).cast("string").alias(" "), *part.columns)
        nameless.write.option("header", True).csv(f"{base}/layout={layout}")
    return csv.scan_text(spark, f"{base}/*").select(*rows.columns)


@_register(
    f"""{relations_sql(keyless=True)}
SELECT CAST("Order ID" AS VARCHAR) AS "Order ID", CAST("Customer ID" AS VARCHAR) AS "Customer ID",
       CAST(strptime("Order Date", '%d-%m-%Y') AS DATE) AS "Order Date"
FROM o"""
)
def csv_scan_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys and a date, bound by name although the file has another order."""
    reordered = orders(spark, sf_dir, keyless=True).select("Order Date", ORDER_KEY, "Customer ID")
    path = export_csv(reordered, scratch_dir(spark, "csv"), "orders")
    scanned = csv.scan_csv(spark, path, types={"Order Date": "date"})
    return scanned.select(ORDER_KEY, "Customer ID", "Order Date")


@_register("SELECT CAST(doc_id AS VARCHAR) AS doc_id, NULLIF(source, '') AS source, NULLIF(text, '') AS text FROM documents")
def csv_scan_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks inside quotes, from files that are split."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return csv.scan_csv(spark, export_csv(texts, scratch_dir(spark, "csv"), "texts"), multi_line=True)


@_register(
    f"""{relations_sql(keyless=True)}
SELECT CAST("Order ID" AS VARCHAR) AS "Order ID", "Return Reason", "Return Date",
       'Return Date' AS rejected
FROM r WHERE CAST(substr("Return Date", 1, 2) AS INTEGER) > 12"""
)
def csv_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-first dates read as month-first: days after the 12th do not fit."""
    path = export_csv(returns(spark, sf_dir, keyless=True), scratch_dir(spark, "csv"), "returns")
    text = csv.scan_text(spark, path)
    rejected = csv.rejected_rows(text, {ORDER_KEY: "bigint", "Return Date": "date"}, "MM-dd-yyyy")
    return rejected.withColumn("rejected", F.array_join(csv.REJECTED, ",")).drop(csv.REJECTED)


@_register(
    """SELECT 'o_' || o_orderkey || '.csv' AS orders_key, 'r_' || o_orderkey || '.csv' AS returns_key,
       's3a://orders/in/o_' || o_orderkey || '.csv' AS orders_path,
       's3a://returns/in/r_' || o_orderkey || '.csv' AS returns_path
FROM orders"""
)
def batch_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "orders").select(
        _name("o_", "o_orderkey", ".csv").alias("orders_key"),
        _name("r_", "o_orderkey", ".csv").alias("returns_key"),
    )
    return with_input_paths(given, "s3a://orders/in/", "s3a://returns/in")


def _name(prefix: str, number: str | Column, suffix: str = "") -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"), F.lit(suffix))


# --- sinks and read-back ---------------------------------------------------


@_register(joined_sql())
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    write_parquet(joined(spark, sf_dir), path)
    return read_result(spark, "parquet", path=path)


@_register(joined_sql(keyless=True))
def parquet_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset replaced by another, and by one whose job dies: the second is read."""
    path = scratch_dir(spark, "snapshots")
    write_snapshot(joined(spark, sf_dir), path)
    write_snapshot(joined(spark, sf_dir, keyless=True), path)
    orders(spark, sf_dir).limit(1).write.parquet(f"{path}/run-{uuid.uuid4().hex}")  # never published
    return read_result(spark, "parquet", path=path)


@_register(joined_sql())
def jdbc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written Parquet to a table and back over several connections."""
    options = _jdbc_options(spark)
    name = _stored_table(spark, joined(spark, sf_dir), options)
    return read_result(spark, "jdbc", table=name, partition_column=ORDER_KEY, **options)


@_register(
    f"""SELECT * REPLACE (CAST(strptime("Return Date", '%d-%m-%Y') AS DATE) AS "Return Date")
FROM ({joined_sql()})"""
)
def jdbc_even_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read in even ranges of the date of return, which a great part of the rows has not."""
    options = _jdbc_options(spark)
    rows = csv.cast_columns(joined(spark, sf_dir), {"Return Date": "date"})
    name = _stored_table(spark, rows, options)
    return read_result(spark, "jdbc", table=name, partition_column="Return Date", even=True, then_by=[ORDER_KEY], **options)


def _stored_table(spark: SparkSession, rows: DataFrame, options: dict[str, str]) -> str:
    """The name of a new table with the rows."""
    name = f"result_{uuid.uuid4().hex}"
    path = scratch_dir(spark, "parquet")
    write_parquet(rows, path)
    stored = read_result(spark, "parquet", path=path)
    write_jdbc(stored, table=name, num_partitions=8, staged=can_stage(options["url"]), attempts=3, **options)
    return name


def _jdbc_options(spark: SparkSession) -> dict[str, str]:
    """The database named by the session, else one inside the process of a local
    session, which other machines could not see."""
    url = spark.conf.get(JDBC_URL, None)
    if url:
        driver = spark.conf.get(JDBC_DRIVER, None)
        return {"url": url, **({"driver": driver} if driver else {})}
    if not is_local(spark):
        raise ValueError(f"set {JDBC_URL} to a database that all executors reach")
    return {
        "url": "jdbc:derby:memory:rejoinder;create=true",
        "driver": "org.apache.derby.jdbc.EmbeddedDriver",
    }


@_register(joined_sql())
def csv_export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export_csv(joined(spark, sf_dir), scratch_dir(spark, "export"))
    return csv.scan_csv(spark, path, types=_BIGINT_KEYS)


@_register(joined_sql(extra=", TIMESTAMP '2024-01-31 12:30:15.25' AS \"UpdatedOn\"", keyless=True))
def csv_batch_to_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job: two CSV inputs, gates, join, stamp, dataset."""
    left, right = _csv_pair(spark, sf_dir, True)
    result = run_batch(
        spark,
        left,
        right,
        scratch_dir(spark, "result"),
        order_types=_BIGINT_KEYS,
        return_types={ORDER_KEY: "bigint"},
        at=RUN_TIME,
    )
    stored = read_result(spark, "parquet", path=result.output_path)
    return stored.withColumn(STAMP, _utc(STAMP))


@_register(f"SELECT count(*) AS n_rows, 5 AS n_cols FROM ({joined_sql()})")
def result_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.result_shape(joined(spark, sf_dir))


@_register("SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_parts, 0 AS unlisted FROM orders")
def result_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files counted in a listing, and those the rows come from found in it."""
    path = scratch_dir(spark, "parts")
    write_parquet(orders(spark, sf_dir).repartitionByRange(5, ORDER_KEY), path)
    files = list_files(spark, path)
    listed = shape.with_suffix(files, key="path").select(_file_name("path"))
    rows = read_result(spark, "parquet", path=path)
    per_part = rows.groupBy(_file_name("_metadata.file_path")).agg(F.count("*").alias("n"))
    found = per_part.join(listed.withColumn("listed", F.lit(True)), "file", "left").agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("listed").isNull()).cast("int").alias("unlisted")
    )
    counted = shape.count_parts(files)
    both = found.unionByName(counted, allowMissingColumns=True)
    return both.agg(*(F.max(name).alias(name) for name in ("n_rows", "n_parts", "unlisted")))


def _file_name(path: str) -> Column:
    return F.substring_index(path, "/", -1).alias("file")


# --- gates and keys --------------------------------------------------------


@_register(
    """SELECT 'orders' AS input, count(*) = 0 AS is_empty, '' AS missing FROM orders
UNION ALL SELECT 'returns', count(*) = 0, '' FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'lower case', count(*) = 0, 'Order ID' FROM orders
UNION ALL SELECT 'none left', count(*) = 0, '' FROM lineitem WHERE l_returnflag = 'X'"""
)
def input_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = orders(spark, sf_dir), returns(spark, sf_dir)
    return gates.gate_report(
        {
            "orders": left,
            "returns": right,
            "lower case": left.withColumnRenamed(ORDER_KEY, ORDER_KEY.lower()),
            "none left": table(spark, sf_dir, "lineitem")
            .filter(F.col("l_returnflag") == "X")
            .select(F.col("l_orderkey").alias(ORDER_KEY)),
        }
    )


@_register(f'{relations_sql(keyless=True)}\nSELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM r WHERE r."Order ID" = o."Order ID")')
def orders_without_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys not there yet are accepted, null keys too."""
    return landing.accepted_keys(orders(spark, sf_dir, True), returns(spark, sf_dir, True), ORDER_KEY)


@_register(f'{relations_sql(keyless=True)}\nSELECT * FROM o WHERE EXISTS (SELECT 1 FROM r WHERE r."Order ID" = o."Order ID")')
def orders_with_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys already there are refused."""
    return landing.refused_keys(orders(spark, sf_dir, True), returns(spark, sf_dir, True), ORDER_KEY)


def _event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", keys.landing_key(F.col("ts"), F.col("event_type")).alias("key")
    )


_EVENT_KEYS = """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_type AS key FROM events"""


@_register(
    f"""SELECT event_id, key, strptime(substr(key, 1, 15), '%Y%m%d_%H%M%S') AS landed_at,
       substr(key, 17) AS name
FROM ({_EVENT_KEYS})"""
)
def landing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_keys(spark, sf_dir).select(
        "event_id",
        "key",
        keys.landed_at(F.col("key")).cast("timestamp_ntz").alias("landed_at"),
        keys.landed_name(F.col("key")).alias("name"),
    )


@_register(f"SELECT * FROM ({_EVENT_KEYS}) WHERE key LIKE '%k'")
def key_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.with_suffix(_event_keys(spark, sf_dir), "k")


@_register(f"SELECT max(key) AS key FROM ({_EVENT_KEYS}) WHERE key LIKE '%k'")
def latest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.latest_key(shape.with_suffix(_event_keys(spark, sf_dir), "k"))


@_register(f"SELECT substr(key, 17) AS name, max(key) AS key FROM ({_EVENT_KEYS}) GROUP BY 1")
def latest_key_per_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _event_keys(spark, sf_dir).withColumn("name", keys.landed_name(F.col("key")))
    return shape.latest_key(named, by=("name",))


# --- requests --------------------------------------------------------------


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order; a pending order names no orders file and an urgent
    one an empty returns file."""
    number = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        number.cast("string").alias("batch"),
        F.when(F.col("o_orderstatus") != "P", _name("o_", number)).alias("orders_key"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "")
        .otherwise(_name("r_", number))
        .alias("returns_key"),
    )


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders files of the orders that have a shipped line, returns files of those
    that have a return; many rows name one file."""
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_orderkey")
    shipped = lines.filter(F.col("l_linestatus") == "F").select(
        F.lit("orders").alias("bucket"), _name("o_", number).alias("key")
    )
    returned = lines.filter(F.col("l_returnflag") == "R").select(
        F.lit("returns").alias("bucket"), _name("r_", number).alias("key")
    )
    return shipped.unionAll(returned)


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answer_requests(
        _manifest(spark, sf_dir), _listing(spark, sf_dir), "orders", "returns", execution_at=1.5
    )


_CHECKED = """WITH m AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS batch,
         CASE WHEN o_orderstatus <> 'P' THEN 'o_' || o_orderkey END AS orders_key,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'r_' || o_orderkey END AS returns_key,
         o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') AS has_orders,
         o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_returns
  FROM orders
), c AS (
  SELECT *, CASE WHEN coalesce(orders_key, '') = '' OR coalesce(returns_key, '') = '' THEN 400
                 WHEN has_orders AND has_returns THEN 200 ELSE 404 END AS status_code
  FROM m
), a AS (
  SELECT batch, orders_key, returns_key, status_code,
         CASE WHEN status_code = 404
              THEN concat_ws(',', CASE WHEN NOT has_orders THEN 'orders/' || orders_key END,
                                  CASE WHEN NOT has_returns THEN 'returns/' || returns_key END)
              ELSE '' END AS missing
  FROM c
)
"""


@_register(_CHECKED + "SELECT batch, orders_key, returns_key, status_code, missing FROM a")
def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select(
        "batch",
        "orders_key",
        "returns_key",
        "status_code",
        F.array_join("missing_files", ",").alias("missing"),
    )


@_register(
    _CHECKED
    + """SELECT batch, CAST(status_code AS BIGINT) AS code,
       CASE status_code WHEN 400 THEN '❌ Missing orders_s3_key or returns_s3_key in input.'
                        WHEN 404 THEN '❌ One or both input files are missing in S3.'
                        ELSE '✅ Step Function triggered successfully' END AS message,
       CASE WHEN status_code = 400 THEN orders_key END AS given_orders,
       CASE WHEN status_code = 400 THEN returns_key END AS given_returns,
       CASE WHEN status_code = 404 THEN missing END AS missing,
       CASE WHEN status_code = 200 THEN batch END AS execution,
       CASE WHEN status_code = 200 THEN orders_key END AS orders_file,
       CASE WHEN status_code = 200 THEN returns_key END AS returns_file,
       CASE WHEN status_code = 200 THEN CAST(1.5 AS DOUBLE) END AS execution_at
FROM a"""
)
def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON answers, parsed again: engines differ in spacing and order."""
    body = (
        "message string, input struct<orders_s3_key: string, returns_s3_key: string>, "
        "missing_files array<string>, executionArn string, orders_file string, "
        "returns_file string, execution_at double"
    )
    answer = F.from_json("answer", "statusCode bigint, body string")
    parsed = _answers(spark, sf_dir).select("batch", answer.alias("answer"))
    return parsed.select(
        "batch", F.col("answer.statusCode").alias("code"), F.from_json("answer.body", body).alias("b")
    ).select(
        "batch",
        "code",
        "b.message",
        F.col("b.input.orders_s3_key").alias("given_orders"),
        F.col("b.input.returns_s3_key").alias("given_returns"),
        F.array_join("b.missing_files", ",").alias("missing"),
        F.col("b.executionArn").alias("execution"),
        "b.orders_file",
        "b.returns_file",
        "b.execution_at",
    )


@_register(
    _CHECKED
    + """SELECT batch, 's3a://in/' || orders_key AS orders_path, 's3a://back/' || returns_key AS returns_path
FROM a WHERE status_code = 200"""
)
def manifest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = accepted_batches(_answers(spark, sf_dir), "s3a://in", "s3a://back")
    return accepted.select("batch", "orders_path", "returns_path")


# --- runs ------------------------------------------------------------------


@_register(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
WHERE event_type <> 'error'"""
)
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose body lists one record; those of errors have another status."""
    answers = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("statusCode"),
        F.concat(F.lit("["), "props", F.lit("]")).alias("body"),
    )
    return responses.decode_records(answers, "struct<k: bigint>", keep=("event_id",))


@_register(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
WHERE event_type IN ('view', 'click')"""
)
def json_records_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of objects, also with other things in them, lists of numbers, lone objects and
    broken text; the type of a record is found in the answers."""
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "view", F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == "click", F.concat(F.lit("[null, 5, "), props, F.lit(', "text", [1]]')))
        .when(kind == "signup", F.lit("[1, 2]"))
        .when(kind == "purchase", props)
        .otherwise(F.lit('[{"k": '))
    )
    answers = table(spark, sf_dir, "events").select("event_id", F.lit(200).alias("statusCode"), body.alias("body"))
    return responses.decode_records(answers, keep=("event_id",)).select("event_id", F.col("k").cast("bigint").alias("k"))


@_register(
    """SELECT user_id, event_id,
       CASE event_type WHEN 'view' THEN '➡️ Entered: ' WHEN 'click' THEN '✅ Exited: '
                       ELSE '❌ Failed: ' END || props AS step
FROM events WHERE event_type IN ('view', 'click', 'error')"""
)
def run_history_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    def details(kind: str, field: str) -> Column:
        return F.when(F.col("event_type") == kind, F.struct(F.col("props").alias(field)))

    history = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        details("view", "name").alias(runs.ENTERED),
        details("click", "name").alias(runs.EXITED),
        details("error", "error").alias(runs.FAILED),
    )
    steps = runs.history_steps(history, keep=("user_id", "event_id"))
    return runs.in_time_order(steps, "user_id", "event_id")


@_register(
    """WITH s AS (
  SELECT event_id, 'o_' || user_id || '.csv' AS orders_key, 'r_' || user_id || '.csv' AS returns_key,
         CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED'
                         WHEN 'signup' THEN 'TIMED_OUT' WHEN 'view' THEN 'RUNNING' END AS status
  FROM events)
SELECT *,
  CASE status WHEN 'SUCCEEDED' THEN 'success' WHEN 'FAILED' THEN 'failure' ELSE 'wait' END AS route,
  coalesce(status IN ('SUCCEEDED', 'FAILED', 'TIMED_OUT', 'ABORTED'), false) AS is_terminal,
  CASE status WHEN 'SUCCEEDED' THEN 'Glue Job Success Notification'
              WHEN 'FAILED' THEN 'Glue Job Failure Notification' END AS subject,
  CASE status WHEN 'SUCCEEDED'
              THEN '✅ Glue job succeeded! Orders File: ' || orders_key || ', Returns File: ' || returns_key
              WHEN 'FAILED' THEN '❌ ETL pipeline failed during Glue job execution.' END AS message
FROM s"""
)
def run_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    given = table(spark, sf_dir, "events").select(
        "event_id",
        _name("o_", "user_id", ".csv").alias("orders_key"),
        _name("r_", "user_id", ".csv").alias("returns_key"),
        F.when(kind == "purchase", "SUCCEEDED")
        .when(kind == "error", "FAILED")
        .when(kind == "signup", "TIMED_OUT")
        .when(kind == "view", "RUNNING")
        .alias("status"),
    )
    return runs.route_runs(given)


# --- arrivals --------------------------------------------------------------

_LANDED = f"""{relations_sql(keyless=True)}
SELECT "Order ID", "Customer ID", CAST(strptime("Order Date", '%d-%m-%Y') AS DATE) AS "Order Date"
FROM o"""

_LANDED_TYPES = {**_BIGINT_KEYS, "Order Date": "date"}


@_register(_LANDED)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders files taken from a folder in several batches; then the checkpoint is lost."""
    base = scratch_dir(spark, "stream")
    rows = orders(spark, sf_dir, keyless=True)
    arrivals = export_csv(rows.repartitionByRange(4, "Customer ID"), base, "arrivals")
    for checkpoint in ("progress", "progress", "another"):
        land_rows(
            spark, arrivals, rows.columns, f"{base}/landed", f"{base}/{checkpoint}", types=_LANDED_TYPES, max_files=2
        ).awaitTermination()
    return read_result(spark, "parquet", path=f"{base}/landed").drop(LANDING_KEY)


@_register(_LANDED)
def stream_landing_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts in one folder: one status has its columns reversed."""
    base = scratch_dir(spark, "stream")
    rows = orders(spark, sf_dir, keyless=True)
    pending = F.col(ORDER_KEY).isNull()
    export_csv(rows.filter(~pending), f"{base}/arrivals", "layout=a")
    export_csv(rows.filter(pending).select(*reversed(rows.columns)), f"{base}/arrivals", "layout=b")
    for checkpoint in ("progress", "progress", "another"):
        land_files(
            spark, f"{base}/arrivals/*", f"{base}/landed", f"{base}/{checkpoint}", types=_LANDED_TYPES, max_files=2
        ).awaitTermination()
    return read_result(spark, "parquet", path=f"{base}/landed").select(*rows.columns)


# Orders per pair of files, and the pairs that there are at least.
_PER_PAIR, _PAIRS = 5_000, 3


@_register(
    f"""{relations_sql(keyless=True)}
, n AS (
  SELECT greatest({_PAIRS}, count(*) // {_PER_PAIR}) AS pairs, min("Order ID") AS low, max("Order ID") AS high FROM o
)
SELECT CAST((o."Order ID" - low) * pairs // (high - low + 1) AS INTEGER) AS pair, o."Order ID", o."Customer ID", o."Order Date",
       r."Return Reason", r."Return Date"
FROM o LEFT JOIN r ON o."Order ID" = r."Order ID", n WHERE o."Order ID" IS NOT NULL"""
)
def arrivals_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of files that arrive at once, one for each range of keys: every pair has its result."""
    base = scratch_dir(spark, "arrivals")
    left, right = orders(spark, sf_dir, keyless=True), returns(spark, sf_dir, keyless=True)
    found = left.agg(F.count(F.lit(1)), F.min(ORDER_KEY), F.max(ORDER_KEY)).first()
    pairs, low, high = max(_PAIRS, found[0] // _PER_PAIR), found[1] or 0, found[2] or 0
    place = F.coalesce(F.expr(f"(`{ORDER_KEY}` - {low}L) * {pairs}L div ({high}L - {low}L + 1)"), F.lit(0))
    inside = F.greatest(F.lit(0), F.least(place, F.lit(pairs - 1))).cast("int")
    for kind, rows in (("orders", left), ("returns", right)):
        # The number of the task is that of the pair and goes into the name of its file.
        export_csv(rows.repartitionById(pairs, inside), base, kind)
    types = {"order_types": _BIGINT_KEYS, "return_types": {ORDER_KEY: "bigint"}, "at": RUN_TIME}
    run_on_arrival(spark, f"{base}/orders", f"{base}/returns", f"{base}/out", f"{base}/progress", **types).awaitTermination()
    number = F.regexp_extract("pair", r"part-(\d+)", 1).cast("int")
    return spark.read.parquet(f"{base}/out").withColumn("pair", number).drop(STAMP)
