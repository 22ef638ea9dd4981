"""Batch requests: codes, missing files, answers, paths."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rejoinder.operators.requests import check_requests, encode_outcome
from rejoinder.plans.requests import accepted_batches, answer_requests
from rejoinder.sources.paths import input_path
from rejoinder.sources.results import list_buckets

MANIFEST = [
    ("m1", "o1.csv", "r1.csv"),
    ("m2", None, "r1.csv"),
    ("m3", "o1.csv", ""),
    ("m4", "none.csv", "r1.csv"),
    ("m5", "o1.csv", "none.csv"),
    ("m6", "none.csv", "none.csv"),
    ("m7", "r1.csv", "o1.csv"),  # there, but in the other bucket
    ("m8", None, None),
]
EXPECTED = {
    "m1": (200, []),
    "m2": (400, []),
    "m3": (400, []),
    "m4": (404, ["orders/none.csv"]),
    "m5": (404, ["returns/none.csv"]),
    "m6": (404, ["orders/none.csv", "returns/none.csv"]),
    "m7": (404, ["orders/r1.csv", "returns/o1.csv"]),
    "m8": (400, []),
}


@pytest.fixture
def manifest(spark):
    return spark.createDataFrame(MANIFEST, "batch string, orders_key string, returns_key string")


@pytest.fixture
def listing(spark):
    files = [("orders", "o1.csv"), ("returns", "r1.csv"), ("returns", "r1.csv"), ("other", "none.csv")]
    return spark.createDataFrame(files, "bucket string, key string")


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("rows_per_task", [1, 1_000_000])
def test_codes_and_missing_files(manifest, listing, request, small, rows_per_task):
    small or request.getfixturevalue("no_broadcast")
    checked = check_requests(manifest, listing, "orders", "returns", rows_per_task)
    assert checked.columns == ["batch", "orders_key", "returns_key", "status_code", "missing_files"]
    assert {r.batch: (r.status_code, r.missing_files) for r in checked.collect()} == EXPECTED
    assert checked.count() == len(MANIFEST)


def test_one_bucket_for_both(manifest, listing):
    one = listing.withColumn("bucket", F.lit("in"))
    codes = {r.batch: r.status_code for r in check_requests(manifest, one, "in", "in").collect()}
    assert codes["m7"] == 200 and codes["m4"] == 200


def test_answers(manifest, listing):
    answers = answer_requests(manifest, listing, "orders", "returns", execution_at=12.5)
    found = {}
    for row in answers.collect():
        answer = json.loads(row.answer)
        found[row.batch] = (answer["statusCode"], json.loads(answer["body"]))
    assert found["m1"] == (
        200,
        {
            "message": "✅ Step Function triggered successfully",
            "executionArn": "m1",
            "orders_file": "o1.csv",
            "returns_file": "r1.csv",
            "execution_at": 12.5,
        },
    )
    assert found["m3"] == (
        400,
        {
            "message": "❌ Missing orders_s3_key or returns_s3_key in input.",
            "input": {"orders_s3_key": "o1.csv", "returns_s3_key": ""},
        },
    )
    assert found["m6"] == (
        404,
        {
            "message": "❌ One or both input files are missing in S3.",
            "missing_files": ["orders/none.csv", "returns/none.csv"],
        },
    )


def test_start_error(manifest, listing):
    checked = check_requests(manifest, listing, "orders", "returns").withColumn("error", F.lit("throttled"))
    found = {r.batch: r for r in encode_outcome(checked).collect()}
    answer = json.loads(found["m1"].answer)
    assert found["m1"].status_code == answer["statusCode"] == 500
    assert json.loads(answer["body"]) == {"message": "❌ Error triggering Step Function", "error": "throttled"}
    assert found["m4"].status_code == 404 and found["m2"].status_code == 400


def test_accepted_batches(manifest, listing):
    answers = answer_requests(manifest, listing, "orders", "returns")
    accepted = accepted_batches(answers, "s3a://orders/", "s3a://returns").collect()
    assert [(r.batch, r.orders_path, r.returns_path) for r in accepted] == [
        ("m1", "s3a://orders/o1.csv", "s3a://returns/r1.csv")
    ]
    assert input_path("s3a://orders/", "o1.csv") == "s3a://orders/o1.csv"


def test_listing_of_folders(spark, write_csv, tmp_path):
    write_csv("a/in/o1.csv", "x")
    write_csv("a/in/a/in/o2 [1].csv", "x")
    write_csv("b/r1.csv", "x")
    buckets = {"orders": str(tmp_path / "a/in"), "returns": f"file:{tmp_path}/b/"}
    found = list_buckets(spark, buckets)
    assert {tuple(r) for r in found.collect()} == {
        ("orders", "o1.csv"), ("orders", "a/in/o2 [1].csv"), ("returns", "r1.csv"),
    }
    manifest = spark.createDataFrame(
        [("m", "a/in/o2 [1].csv", "r1.csv"), ("n", "o2.csv", "r1.csv")],
        "batch string, orders_key string, returns_key string",
    )
    answers = answer_requests(manifest, found, "orders", "returns")
    assert {r.batch: (r.status_code, r.message[0]) for r in answers.collect()} == {"m": (200, "✅"), "n": (404, "❌")}
