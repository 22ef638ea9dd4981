"""Run history, routing, notices, keys and shapes."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rejoinder.functions import keys
from rejoinder.operators import runs, shape
from rejoinder.sources.responses import decode_records, record_type
from tests.conftest import rows

HISTORY = (
    "run string, event_id bigint, stateEnteredEventDetails struct<name:string>, "
    "stateExitedEventDetails struct<name:string>, executionFailedEventDetails struct<error:string>"
)


def test_history(spark):
    events = [
        ("b", 2, None, ("Start",), None),
        ("b", 1, ("Start",), None, None),
        ("a", 3, None, None, ("Boom",)),
        ("a", 2, ("Wait",), ("Wait",), ("Boom",)),  # the first kind wins
        ("a", 1, None, None, None),  # another kind of event
        ("a", 4, (None,), None, None),
    ]
    steps = runs.in_time_order(runs.history_steps(spark.createDataFrame(events, HISTORY)))
    assert [tuple(r) for r in steps.collect()] == [
        ("a", 2, "➡️ Entered: Wait"),
        ("a", 3, "❌ Failed: Boom"),
        ("a", 4, "➡️ Entered: None"),
        ("b", 1, "➡️ Entered: Start"),
        ("b", 2, "✅ Exited: Start"),
    ]


@pytest.mark.parametrize(
    "state, route, over, subject",
    [
        ("SUCCEEDED", "success", True, "Glue Job Success Notification"),
        ("FAILED", "failure", True, "Glue Job Failure Notification"),
        ("TIMED_OUT", "wait", True, None),
        ("ABORTED", "wait", True, None),
        ("STOPPED", "wait", False, None),
        ("succeeded", "wait", False, None),
        (None, "wait", False, None),
    ],
)
def test_routing(spark, state, route, over, subject):
    given = spark.createDataFrame([(state, "o.csv", "r.csv")], "status string, orders_key string, returns_key string")
    found = runs.route_runs(given).first()
    message = {
        "success": "✅ Glue job succeeded! Orders File: o.csv, Returns File: r.csv",
        "failure": "❌ ETL pipeline failed during Glue job execution.",
    }.get(route)
    assert (found.route, found.is_terminal, found.subject, found.message) == (route, over, subject, message)


def test_nested_state(spark):
    state = spark.createDataFrame(
        [((("SUCCEEDED",),), "o", "r")],
        "JobRun struct<JobRun:struct<JobRunState:string>>, orders_key string, returns_key string",
    )
    assert runs.route_runs(state, "JobRun.JobRun.JobRunState").first().route == "success"


def test_landing_keys(spark):
    at = datetime(2023, 8, 1, 9, 5, 7, 999999)
    df = spark.createDataFrame([(at, "my_orders.csv")], "t timestamp, n string").select(
        keys.landing_key(F.col("t"), F.col("n")).alias("key")
    )
    assert df.first().key == "20230801_090507_my_orders.csv"
    back = df.select(keys.landed_at(F.col("key")).cast("string"), keys.landed_name(F.col("key")))
    assert tuple(back.first()) == ("2023-08-01 09:05:07", "my_orders.csv")
    other = spark.createDataFrame([("orders.csv",), ("20239901_000000_x",)], "key string")
    assert rows(other.select(keys.landed_at(F.col("key")), keys.landed_name(F.col("key")))) == [
        (None, None), (None, "x"),
    ]


def test_suffix_and_latest(spark):
    names = spark.createDataFrame(
        [("final/part-2.parquet",), ("final/part-10.parquet",), ("final/_SUCCESS",), ("final/part-9.PARQUET",)],
        "key string",
    )
    assert rows(shape.with_suffix(names)) == [("final/part-10.parquet",), ("final/part-2.parquet",)]
    assert shape.count_parts(names, path="key").first().n_parts == 2
    assert shape.latest_key(shape.with_suffix(names)).first().key == "final/part-2.parquet"
    grouped = names.withColumn("g", F.length("key"))
    assert shape.latest_key(grouped, by=("g",)).count() == 3


def test_shape(spark):
    df = spark.range(7).withColumn("x", F.lit(1))
    assert tuple(shape.result_shape(df).first()) == (7, 2)


RESPONSES = [
    (200, '[{"Order ID": "A1", "n": 1}, {"Order ID": "A2", "n": 2.5, "w": null}]'),
    (200, '  [{"Order ID": "A3"}]'),
    (200, '{"Order ID": "A4"}'),
    (200, '[{"Order ID": "A5"'),
    (200, "[]"),
    (200, None),
    (500, '[{"Order ID": "A6"}]'),
    (None, '[{"Order ID": "A7"}]'),
]


@pytest.mark.parametrize("record", ["struct<`Order ID`: string, n: double>", None])
def test_json_records(spark, record):
    responses = spark.createDataFrame(RESPONSES, "statusCode int, body string")
    decoded = decode_records(responses, record)
    assert rows(decoded, "Order ID", "n") == [("A1", 1.0), ("A2", 2.5), ("A3", None)]


def test_record_type(spark):
    responses = spark.createDataFrame(RESPONSES, "statusCode int, body string")
    assert record_type(responses.filter("false")) is None
    assert decode_records(responses.filter("statusCode = 500")).count() == 0
    nested = spark.createDataFrame(
        [(200, '[{"a": {"b": [1, 2]}, "OBJECT": "x"}]')], "statusCode int, body string"
    )
    assert decode_records(nested).selectExpr("a.b[1]", "OBJECT").first()[:] == (2, "x")


def test_odd_answers_cost_only_themselves(spark):
    bodies = ['[{"a": 1}]', "[1]", '[null, 5, {"a": 2, "b": "x"}, "{}", [{"a": 9}]]', '{"a": 3}', "[{", None, "[]", '[{"a": "t"}]']
    answers = spark.createDataFrame([(200, b) for b in bodies] + [(500, '[{"a": 7}]')], "statusCode int, body string")
    assert rows(decode_records(answers), "a", "b") == [("1", None), ("2", "x"), ("t", None)]
    assert rows(decode_records(answers, "struct<a: int>"), "a") == [(None,), (1,), (2,)]


def test_names_like_types(spark):
    answers = spark.createDataFrame([(200, '[{"VOID": 1, "OBJECT<x": {"VARIANT": null}}]')], "statusCode int, body string")
    assert decode_records(answers).first().asDict(True) == {"VOID": 1, "OBJECT<x": {"VARIANT": None}}
