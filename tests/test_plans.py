"""What the plans look like: pushed filters, pruned columns, no slow nodes."""

from __future__ import annotations

import re

import pytest

from rejoinder.operators.enrich import drop_null_keys, join_returns
from rejoinder.plans import catalog
from rejoinder.plans.relations import orders, returns
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
SLOW = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups", "PythonUDF")


@pytest.fixture
def plan(capsys):
    def text(df) -> str:
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_slow_nodes(spark, plan, name):
    text = plan(catalog.queries()[name](spark, SF_DIR))
    assert not [node for node in SLOW if node in text]


def test_join_pushes_and_prunes(spark, plan, no_broadcast):
    text = plan(catalog.orders_returns_left_join(spark, SF_DIR))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in text
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R), IsNotNull(l_orderkey)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "l_extendedprice" not in text


def test_a_small_right_side_is_broadcast(spark, plan):
    text = plan(catalog.orders_returns_left_join(spark, SF_DIR))
    assert "BroadcastHashJoin LeftOuter BuildRight" in text


def test_unread_columns_are_not_scanned(spark, plan):
    text = plan(catalog.orders_returns_left_join(spark, SF_DIR).select("Order ID"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    assert "l_shipdate" not in text.split("ReadSchema", 1)[1]


def test_salted_join_broadcasts_only_the_list(spark, plan, no_broadcast):
    left, right = orders(spark, SF_DIR), returns(spark, SF_DIR)
    text = plan(drop_null_keys(join_returns(left, right, rows_per_task=5)))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    # The list of hot keys has a proven bound, see hot_keys.
    assert "__salt" in text and 1 <= len(re.findall(r"^\(\d+\) BroadcastExchange", text, re.M)) <= 2
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in text
    assert "IsNotNull(l_orderkey)]" in text


def test_csv_filters_reach_the_scan(spark, plan, tmp_path):
    orders(spark, SF_DIR, True).write.option("header", True).csv(str(tmp_path / "o"))
    left = catalog.csv.scan_csv(spark, str(tmp_path / "o"))
    text = plan(drop_null_keys(join_returns(left, left.select("Order ID"))))
    assert text.count("PushedFilters: [IsNotNull(Order ID)]") == 2


def test_anti_join_collapses_copies_first(spark, plan, no_broadcast):
    text = plan(catalog.orders_without_returns(spark, SF_DIR))
    assert "LeftAnti" in text and len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) HashAggregate", text, re.M)) == 2


def test_listing_opens_no_file(spark, plan, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    text = plan(catalog.list_files(spark, str(tmp_path / "p")).select("path"))
    assert "ReadSchema: struct<path:string>" in text


def test_gates_read_one_row(spark, plan):
    text = plan(catalog.input_gates(spark, SF_DIR))
    assert text.count("Limit") >= 4


def test_casts_of_rejects_are_made_once(spark, plan, write_csv):
    path = write_csv("a.csv", "Order ID,When\n1,2024\n")
    text = plan(catalog.csv.rejected_rows(catalog.csv.scan_text(spark, path), {"When": "date"}))
    assert text.count("gettimestamp") + text.count("try_to_date") <= 3
