"""The whole job on a small pair of files, golden and failing ones."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException

from rejoinder.__main__ import main, parse_arguments
from rejoinder.operators.gates import InputError
from rejoinder.plans.batch import overlaps, run_batch
from rejoinder.sources.results import read_jdbc_result, read_parquet_result
from tests.conftest import rows

AT = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}

ORDERS = "\r\n".join(
    [
        "Order ID,Customer ID,Product ID,Order Date",
        "A1,K7,P3,11-02-2024",
        "A2,K8,P3,12-02-2024",
        "A3,K7,P1,12-02-2024",
        "A4,K9,P2,13-02-2024",
        "A5,K8,P2,13-02-2024",
        "A6,K5,P1,14-02-2024",
        "A7,K5,P3,15-02-2024",
        "A8,K9,P1,16-02-2024",
        "A9,K7,P2,17-02-2024",
        "",
    ]
)
RETURNS = "\r\n".join(
    [
        "Order ID,Return Reason,Return Date",
        "A9,Too late,19-02-2024",
        "A2,Damaged,14-02-2024",
        "A6,Changed Mind,15-02-2024",
        "A7,Damaged,18-02-2024",
        "",
    ]
)
RETURNED = {
    "A2": ("Damaged", "14-02-2024"),
    "A6": ("Changed Mind", "15-02-2024"),
    "A7": ("Damaged", "18-02-2024"),
    "A9": ("Too late", "19-02-2024"),
}


@pytest.fixture
def pair(write_csv):
    return write_csv("in/orders.csv", ORDERS), write_csv("back/returns.csv", RETURNS)


@pytest.mark.parametrize("mode", ["declared", "inferred"])
def test_golden_pair(spark, pair, tmp_path, mode):
    result = run_batch(spark, *pair, str(tmp_path / "out"), mode=mode, at=AT)
    stored = read_parquet_result(spark, result.output_path)
    assert result.succeeded
    assert stored.columns == [
        "Order ID", "Customer ID", "Product ID", "Order Date", "Return Reason", "Return Date", "UpdatedOn",
    ]
    assert [t for _, t in stored.dtypes] == ["string"] * 6 + ["timestamp"]
    found = {r["Order ID"]: (r["Return Reason"], r["Return Date"]) for r in stored.collect()}
    assert found == {f"A{i}": RETURNED.get(f"A{i}", (None, None)) for i in range(1, 10)}
    stamps = {r[0] for r in stored.selectExpr("cast(UpdatedOn as string)").collect()}
    assert stamps == {"2024-05-06 07:08:09.123456"}


def test_declared_types(spark, pair, tmp_path):
    run_batch(spark, *pair, str(tmp_path / "out"), order_types={"Order Date": "date"}, at=AT)
    assert dict(spark.read.parquet(str(tmp_path / "out")).dtypes)["Order Date"] == "date"


def test_both_sinks_hold_the_same(spark, pair, tmp_path):
    jdbc = {"url": "jdbc:derby:memory:both;create=true", "table": "results", **DERBY}
    for _ in range(2):  # the second run replaces the first
        result = run_batch(spark, *pair, str(tmp_path / "out"), jdbc=jdbc)
    assert result.succeeded and result.jdbc_table == "results"
    table = read_jdbc_result(spark, jdbc["url"], "results", **DERBY)
    assert rows(table) == rows(read_parquet_result(spark, str(tmp_path / "out")))
    assert table.count() == 9


def test_failing_table_leaves_new_dataset(spark, pair, tmp_path):
    jdbc = {"url": "jdbc:derby:memory:absent", "table": "results", **DERBY}
    result = run_batch(spark, *pair, str(tmp_path / "out"), jdbc=jdbc)
    assert not result.succeeded and result.jdbc_error
    assert read_parquet_result(spark, str(tmp_path / "out")).count() == 9


def test_dataset_is_replaced(spark, pair, write_csv, tmp_path):
    out = str(tmp_path / "out")
    run_batch(spark, *pair, out)
    short = write_csv("in/short.csv", "Order ID,Customer ID\nA2,K1\n")
    run_batch(spark, short, pair[1], out)
    assert rows(read_parquet_result(spark, out), "Order ID", "Return Reason") == [("A2", "Damaged")]


@pytest.mark.parametrize("text", ["", "Order ID,Return Reason\n"])
def test_empty_input_stops(spark, pair, write_csv, tmp_path, text):
    with pytest.raises(InputError, match="no rows in: returns"):
        run_batch(spark, pair[0], write_csv("empty.csv", text), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("header", ["order id,x", "Order ID ,x", "Order ID,Order ID", "id,x"])
@pytest.mark.filterwarnings("ignore:blank or doubled")
def test_missing_key_column_stops(spark, pair, write_csv, tmp_path, header):
    with pytest.raises(InputError, match="missing columns"):
        run_batch(spark, pair[0], write_csv("r.csv", f"{header}\n1,2\n"), str(tmp_path / "out"))


def test_missing_file_stops(spark, pair, tmp_path):
    with pytest.raises(AnalysisException) as error:
        run_batch(spark, pair[0], str(tmp_path / "nothing.csv"), str(tmp_path / "out"))
    assert error.value.getCondition() == "PATH_NOT_FOUND"


def test_clashing_column_stops(spark, pair, write_csv, tmp_path):
    other = write_csv("r.csv", "Order ID,ORDER DATE\nA1,x\n")
    with pytest.raises(InputError, match="ORDER DATE"):
        run_batch(spark, pair[0], other, str(tmp_path / "out"))


def test_output_over_input_stops(spark, pair, tmp_path):
    for output in (pair[0], str(tmp_path / "in"), pair[0] + "/x", "file:" + pair[0]):
        with pytest.raises(InputError, match="overwrite"):
            run_batch(spark, *pair, output)


@pytest.mark.parametrize("pattern", ["*/x.csv", "{a,b}/x.csv", "c/../a/x.csv", "?/*.csv", "."])
def test_output_over_resolved_input_stops(spark, pair, write_csv, tmp_path, pattern):
    file = write_csv("ov/a/x.csv", "Order ID,c\n1,a\n")
    write_csv("ov/c/y.csv", "Order ID,c\n2,b\n")
    for out in ("ov/a", "ov/./a", "ov//c/../a"):
        with pytest.raises(InputError, match="overwrite"):
            run_batch(spark, f"{tmp_path}/ov/{pattern}", pair[1], f"{tmp_path}/{out}")
    assert open(file).read().startswith("Order ID")


def test_rejects_are_kept(spark, pair, write_csv, tmp_path):
    orders = write_csv("in/bad.csv", "Order ID,n,When\nA2,1,01-08-2023\nA6,x,2023-08-01\nA9,,31-02-2023\n")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    types = {"n": "int", "When": "date"}
    run_batch(spark, orders, pair[1], out, order_types=types, rejects_path=rejects)
    assert rows(spark.read.parquet(out), "Order ID", "n") == [("A2", 1), ("A6", None), ("A9", None)]
    kept = spark.read.parquet(rejects + "/orders")
    assert {r["Order ID"]: (r.n, r.When, r.rejected_columns) for r in kept.collect()} == {
        "A6": ("x", "2023-08-01", ["n", "When"]), "A9": (None, "31-02-2023", ["When"]),
    }
    assert spark.read.parquet(rejects + "/returns").count() == 0
    for place in (out + "/rejects", str(tmp_path / "in")):
        with pytest.raises(InputError, match="overlap|overwrite"):
            run_batch(spark, orders, pair[1], out, order_types=types, rejects_path=place)


@pytest.mark.parametrize("trim", [False, True])
def test_blank_keys(spark, write_csv, tmp_path, trim):
    orders = write_csv("o.csv", "Order ID,c\nA1 ,x\n   ,y\nA2,z\n")
    returns = write_csv("r.csv", "Order ID,r\n A1,u\n  ,v\n")
    run_batch(spark, orders, returns, str(tmp_path / "out"), trim_keys=trim)
    expected = [("A1", "u"), ("A2", None)] if trim else [("   ", None), ("A1 ", None), ("A2", None)]
    assert rows(spark.read.parquet(str(tmp_path / "out")), "Order ID", "r") == expected


def test_overlaps():
    assert overlaps("s3a://b/x/", "s3a://b/x/in.csv")
    assert overlaps("s3a://b/x/out", "s3a://b/x/*")
    assert not overlaps("s3a://b/out", "s3a://b/output/in.csv")
    assert not overlaps("s3a://a/x", "s3a://b/x")


def test_command_line(spark, pair, tmp_path):
    base = str(tmp_path)
    given = [
        "--JOB_NAME", "nightly", "--orders_s3_key", "in/orders.csv", "--returns_s3_key", "back/returns.csv",
        "--base_orders", base, "--base_returns", base + "/", "--output", base + "/out",
    ]
    assert main(given) == 0
    assert read_parquet_result(spark, base + "/out").count() == 9
    more = ["--order_type", "Order Date=date", "--return_type", "Return Date=date", "--trim_keys"]
    more += ["--rejects", base + "/rejects", "--jdbc_url", "jdbc:derby:memory:cli;create=true"]
    assert main(given + more + ["--jdbc_table", "results", "--jdbc_driver", DERBY["driver"]]) == 0
    assert dict(read_parquet_result(spark, base + "/out").dtypes)["Return Date"] == "date"
    assert read_jdbc_result(spark, "jdbc:derby:memory:cli", "results", **DERBY).count() == 9
    assert main(given + ["--jdbc_url", "jdbc:derby:memory:none", "--jdbc_table", "t"]) == 1
    given[3] = "in/none.csv"
    assert main(given) == 1
    with pytest.raises(SystemExit):
        parse_arguments(given[:4])
    with pytest.raises(SystemExit):
        parse_arguments(given + ["--order_type", "date"])
