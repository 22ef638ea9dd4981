"""Arrivals: once each, by name, nothing doubled."""

from __future__ import annotations

import os
import time
from datetime import date

import pytest

from rejoinder.operators.gates import InputError
from rejoinder.plans.arrivals import Pair, file_name, run_pairs
from rejoinder.streaming.landing import LANDING_KEY, land_files, land_rows
from rejoinder.sources.results import read_result
from rejoinder.streaming.trigger import run_on_arrival, runs
from tests.conftest import rows


def test_rows_land_once(spark, write_csv, tmp_path):
    def run():
        land_rows(
            spark, str(tmp_path / "in"), ["Order ID", "When"], str(tmp_path / "out"), str(tmp_path / "cp"),
            types={"When": "date"},
        ).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    write_csv("in/orders.csv", "Order ID,When\n1,01-08-2023\n")
    assert rows(run(), "Order ID", "When") == [("1", date(2023, 8, 1))]
    assert rows(run(), "Order ID") == [("1",)]
    write_csv("in/more.csv", 'Order ID,When\n2,bad\n"3",\n')
    landed = run()
    assert rows(landed, "Order ID", "When") == [("1", date(2023, 8, 1)), ("2", None), ("3", None)]
    names = {r[0][16:] for r in landed.select(LANDING_KEY).collect()}
    assert names == {"orders.csv", "more.csv"}
    assert landed.filter(f"{LANDING_KEY} rlike '^[0-9]{{8}}_[0-9]{{6}}_'").count() == 3


@pytest.mark.parametrize("land", ["rows", "files"])
def test_old_files_are_not_passed_over(spark, write_csv, tmp_path, land):
    def run():
        folders = [str(tmp_path / name) for name in ("in", "out", "cp")]
        if land == "rows":
            land_rows(spark, folders[0], ["Order ID", "x"], *folders[1:]).awaitTermination()
        else:
            land_files(spark, *folders).awaitTermination()
        return rows(spark.read.parquet(folders[1]), "Order ID")

    write_csv("in/new.csv", "Order ID,x\n1,a\n")
    assert run() == [("1",)]
    old = write_csv("in/old.csv", "Order ID,x\n2,b\n")
    month_ago = time.time() - 30 * 86_400
    os.utime(old, (month_ago, month_ago))
    assert run() == [("1",), ("2",)]


def test_other_header_stops_the_stream(spark, write_csv, tmp_path):
    write_csv("in/orders.csv", "When,Order ID\n1,2\n")
    query = land_rows(spark, str(tmp_path / "in"), ["Order ID", "When"], str(tmp_path / "out"), str(tmp_path / "cp"))
    with pytest.raises(Exception, match="(?i)header|failed"):
        query.awaitTermination()


def test_files_land_by_name(spark, write_csv, tmp_path):
    def run():
        land_files(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), max_files=2
        ).awaitTermination()
        return spark.read.option("mergeSchema", True).parquet(str(tmp_path / "out"))

    write_csv("in/a.csv", "Order ID,x\n1,a\n")
    write_csv("in/b [c].csv", "x,Order ID\nb,2\n")
    write_csv("in/zero.csv", "")
    write_csv("in/notes.txt", "not,a,table\n")
    assert rows(run(), "Order ID", "x") == [("1", "a"), ("2", "b")]
    write_csv("in/d.csv", "Order ID,x,y\n3,c,z\n")
    landed = run()
    assert rows(landed, "Order ID", "x", "y") == [("1", "a", None), ("2", "b", None), ("3", "c", "z")]
    batches = landed.select("batch_id").distinct().count()
    assert rows(run()) == rows(landed) and batches >= 2


@pytest.mark.filterwarnings("ignore:blank or doubled")
@pytest.mark.parametrize("first", ["Order ID,x", "x,Order ID", "Order ID,x,y", "Order ID", "Order ID,x,x", ",Order ID,x"])
def test_any_mixture_of_headers(spark, write_csv, tmp_path, first):
    values = {"Order ID": "1", "x": "a", "y": "b", "": "0"}
    write_csv("in/a.csv", f"{first}\n" + ",".join(values[name] for name in first.split(",")) + "\n")
    write_csv("in/b.csv", "Order ID,x\n2,c\n3,d\n")
    write_csv("in/c.csv", "\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n")
    land_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "out"))
    seen = "a" if first.split(",").count("x") == 1 else None
    assert rows(landed, "Order ID", "x") == [("1", seen), ("2", "c"), ("3", "d")]


@pytest.mark.parametrize("land", ["rows", "files"])
def test_lost_checkpoint_neither_skips_nor_doubles(spark, write_csv, tmp_path, land):
    def run(checkpoint):
        folders = [str(tmp_path / name) for name in ("in", "out", checkpoint)]
        if land == "rows":
            query = land_rows(spark, folders[0], ["Order ID", "x"], *folders[1:], max_files=1)
        else:
            query = land_files(spark, *folders, max_files=1)
        query.awaitTermination()
        return rows(read_result(spark, "parquet", path=folders[1]), "Order ID", "x")

    for i in range(3):
        write_csv(f"in/{i}.csv", f"Order ID,x\n{i},a\n")
    wanted = [(str(i), "a") for i in range(3)]
    assert run("cp1") == wanted
    write_csv("in/3.csv", "Order ID,x\n3,a\n")
    wanted.append(("3", "a"))
    assert run("cp2") == wanted and run("cp2") == wanted
    write_csv("in/4.csv", "Order ID,x\n4,a\n")
    wanted.append(("4", "a"))
    assert run("cp1") == wanted == run("cp3")
    landed = read_result(spark, "parquet", path=str(tmp_path / "out"))
    assert sorted(r[0][16:] for r in landed.select(LANDING_KEY).collect()) == [f"{i}.csv" for i in range(5)]


def test_columns_of_all_batches_come_back(spark, write_csv, tmp_path):
    folders = [str(tmp_path / name) for name in ("in", "out", "cp")]
    write_csv("in/a.csv", "Order ID,x\n1,a\n")
    land_files(spark, *folders).awaitTermination()
    write_csv("in/b.csv", "Order ID,Coupon\n2,c\n")
    land_files(spark, *folders).awaitTermination()
    landed = read_result(spark, "parquet", path=folders[1])
    assert rows(landed, "Order ID", "x", "Coupon") == [("1", "a", None), ("2", None, "c")]


def test_every_pair_runs(spark, write_csv, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "cp")
    for folder in ("orders", "returns"):
        (tmp_path / folder).mkdir()

    def run():
        run_on_arrival(spark, str(tmp_path / "orders"), str(tmp_path / "returns"), out, state).awaitTermination()
        if not (tmp_path / "out").exists():
            return None
        return sorted(map(tuple, spark.read.parquet(out).selectExpr("left(pair, 8)", "`Order ID`", "r").collect()), key=str)

    def arrive(day, kind, text):
        write_csv(f"{kind}/2024010{day}_000000_{kind}.csv", text)

    arrive(1, "orders", "Order ID,c\n1,a\n")
    assert run() is None  # waits for its returns
    arrive(1, "returns", "Order ID,r\n1,x\n")
    first = [("20240101", "1", "x")]
    assert run() == first == run()
    for day in (2, 3, 4):
        arrive(day, "orders", f"Order ID,c\n{day},a\n")
        arrive(day, "returns", f"{'order id' if day == 3 else 'Order ID'},r\n{day},y\n")
    found = first + [("20240102", "2", "y"), ("20240104", "4", "y")]
    assert run() == found == run()
    listed = {r.pair[:8]: r.error for r in runs(spark, state).collect()}
    assert listed.keys() == {"20240101", "20240102", "20240103", "20240104"}
    assert [day for day, error in listed.items() if error] == ["20240103"]
    arrive(5, "returns", "Order ID,r\n5,z\n")
    arrive(5, "orders", "Order ID,c\n5,a\n")
    arrive(6, "orders", "Order ID,c\n6,a\n")
    assert run() == found + [("20240105", "5", "z")]


def paired(write_csv, tmp_path, texts):
    """Files of pairs, by number; returns the pairs as listed."""
    found = []
    for i, (orders, returns) in enumerate(texts):
        paths = [write_csv(f"{kind}/{i:03d} a+b%41[{kind}].csv", text) for kind, text in (("orders", orders), ("returns", returns))]
        found.append(Pair(file_name(paths[0]), *[f"file:{path}" for path in paths]))
    return found


def jobs_of(spark, work):
    name = f"jobs-{time.time()}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_pairs(spark, write_csv, tmp_path):
    def texts(n):
        return [(f"Order ID,c\n{i},a\n{i}0,b\n,none\n", f"Order ID,r\n{i},x\n{i},y\n") for i in range(n)]

    counts = []
    for n in (35, 110):  # from 33 paths on, Spark lists them by jobs of its own
        pairs, out = paired(write_csv, tmp_path / str(n), texts(n)), str(tmp_path / f"out{n}")
        counts.append(jobs_of(spark, lambda: run_pairs(spark, pairs, out)))
        found = rows(spark.read.parquet(out), "pair", "Order ID", "c", "r")
        wanted = [(p.name, k, c, r) for i, p in enumerate(pairs) for k, c, r in ((f"{i}", "a", "x"), (f"{i}", "a", "y"), (f"{i}0", "b", None))]
        assert found == sorted(wanted, key=lambda r: [(v is not None, str(v)) for v in r])
    assert counts[0] == counts[1] <= 20


def test_pairs_of_many_kinds(spark, write_csv, tmp_path):
    texts = [
        ("Order ID,c\n01,a\n", "Order ID,r\n1,x\n"),
        ("c,Order ID\na,1\n", "Order ID,r,s\n1,x,y\n"),
        ("order id,c\n1,a\n", "Order ID,r\n1,x\n"),
        ("", "Order ID,r\n1,x\n"),
        ("Order ID,c\n1,a\n", "Order ID,r\n\n \n"),
        ("Order ID,c\n1,a\n", "Order ID,C\n1,x\n"),
        ("Order ID,Pair\n1,a\n", "Order ID,r\n1,x\n"),
        ("Order ID,c\n,a\n", "Order ID,r\n1,x\n"),
        ("Order ID,c\n9,a\n", "Order ID,r\n1,x\n"),
    ]
    pairs, out = paired(write_csv, tmp_path, texts), str(tmp_path / "out")
    for _ in range(2):  # the second run replaces the first
        errors = run_pairs(spark, pairs, out)
        bad = {i: errors[p.name] for i, p in enumerate(pairs) if errors[p.name]}
        assert list(bad) == [2, 3, 4, 5, 6] and "'C'" in bad[5] and "Pair" in bad[6] and "missing columns" in bad[2]
        assert [bad[i] for i in (3, 4)] == ["no rows in: orders", "no rows in: returns"]
        found = spark.read.option("mergeSchema", True).parquet(out)
        names = {p.name: i for i, p in enumerate(pairs)}
        got = sorted((names[r.pair], r["Order ID"], r.c, r.r, r.s) for r in found.collect())
        assert got == [(0, "01", "a", None, None), (1, "1", "a", "x", "y"), (8, "9", "a", None, None)]


def test_pairs_with_types_and_frequent_keys(spark, write_csv, tmp_path, no_broadcast):
    texts = [("Order ID,c\n01,a\n2,b\n", "Order ID,r\n" + "1,x\n" * 40 + "2,y\n"), ("Order ID,c\n1,a\nbad,b\n", "Order ID,r\n3,x\n")]
    pairs, out = paired(write_csv, tmp_path, texts), str(tmp_path / "out")
    options = {"order_types": {"Order ID": "int"}, "return_types": {"Order ID": "int"}, "rows_per_task": 5}
    assert set(run_pairs(spark, pairs, out, **options).values()) == {None}
    found = spark.read.parquet(out).groupBy("pair", "Order ID", "c", "r").count()
    assert {tuple(r)[1:] for r in found.collect()} == {(1, "a", None, 1), (1, "a", "x", 40), (2, "b", "y", 1)}


def test_output_among_the_inputs_is_refused(spark, write_csv, tmp_path):
    pairs = paired(write_csv, tmp_path, [("Order ID,c\n1,a\n", "Order ID,r\n1,x\n")])
    with pytest.raises(InputError, match="overwrite"):
        run_pairs(spark, pairs, str(tmp_path))
    assert run_pairs(spark, [], str(tmp_path / "out")) == {}


def test_arrivals_with_options_of_single_pairs(spark, write_csv, tmp_path):
    write_csv("orders/1.csv", 'Order ID,c\n1,"a\nb"\n')
    write_csv("returns/1.csv", "Order ID,r\n1,x\n")
    folders = [str(tmp_path / name) for name in ("orders", "returns", "out", "cp")]
    run_on_arrival(spark, *folders, multi_line=True).awaitTermination()
    assert rows(spark.read.parquet(folders[2]), "pair", "Order ID", "c", "r") == [("1.csv", "1", "a\nb", "x")]
