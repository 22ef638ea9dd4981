"""The list of landed files: whole after any merge, few files however many batches."""

from __future__ import annotations

import os
import shutil
from functools import partial

import pytest

from rejoinder.sources.results import read_result
from rejoinder.streaming import landing, ledger
from rejoinder.streaming.landing import LANDING_KEY, land_files, land_rows
from tests.conftest import rows


def key(i):
    return f"20240506_{i:06d}_f{i}.csv"


def folder(i):
    return f"batch_id=stream-{i}"


def folders(target):
    return sorted(os.listdir(f"{target}/{ledger.LEDGER}"))


def add(spark, target, batches, fan):
    for i in batches:
        ledger.add_landed(spark, target, folder(i), [key(2 * i), key(2 * i + 1)], fan)


def wanted(batches):
    return sorted((key(k), folder(i)) for i in batches for k in (2 * i, 2 * i + 1))


def test_levels_hold_every_key_in_few_folders(spark, tmp_path):
    target = str(tmp_path)
    assert ledger.landed_files(spark, target).count() == 0
    for i in range(30):
        add(spark, target, [i], 3)
        digits = []  # of the number of batches to the base 3: so many folders stand at each level
        n = i + 1
        while n:
            n, digit = divmod(n, 3)
            digits.append(digit)
        assert len(folders(target)) == sum(digits)
    assert rows(ledger.landed_files(spark, target)) == wanted(range(30))
    assert [name.partition("-")[0] for name in folders(target)] == ["merged=1", "merged=3"]
    between = ledger.landed_files(spark, target, (key(7), key(9)))
    assert rows(between) == [(key(7), folder(3)), (key(8), folder(4)), (key(9), folder(4))]


def test_a_batch_that_runs_again_replaces_its_entry(spark, tmp_path):
    target = str(tmp_path)
    add(spark, target, [0, 0, 1, 1], 3)
    assert folders(target) == [folder(0), folder(1)]
    add(spark, target, [2, 2], 3)  # the second time after its keys were merged
    assert sorted(set(rows(ledger.landed_files(spark, target)))) == wanted(range(3))


def test_a_merge_that_dies_loses_nothing(spark, tmp_path):
    target = str(tmp_path)
    add(spark, target, range(2), 3)
    kept = str(tmp_path / "copy")
    shutil.copytree(f"{target}/{ledger.LEDGER}", kept)
    os.makedirs(f"{target}/{ledger.LEDGER}/merged=1-dead/_temporary/0")  # died while it wrote
    add(spark, target, [2], 3)
    for name in os.listdir(kept):  # died before it deleted
        shutil.copytree(f"{kept}/{name}", f"{target}/{ledger.LEDGER}/{name}")
    assert sorted(set(rows(ledger.landed_files(spark, target)))) == wanted(range(3))
    add(spark, target, range(3, 5), 3)
    assert sorted(set(rows(ledger.landed_files(spark, target)))) == wanted(range(5))
    add(spark, target, range(5, 12), 3)
    assert sorted(set(rows(ledger.landed_files(spark, target)))) == wanted(range(12))


def test_merged_files_are_sorted_and_the_range_is_pushed(spark, tmp_path, capsys):
    target = str(tmp_path)
    add(spark, target, [3, 1, 0, 2], 4)
    (name,) = folders(target)
    found = [row[0] for row in spark.read.parquet(f"{target}/{ledger.LEDGER}/{name}").collect()]
    assert found == [key(i) for i in range(8)]
    ledger.landed_files(spark, target, (key(1), key(2))).explain("formatted")
    plan = capsys.readouterr().out
    assert f"GreaterThanOrEqual({LANDING_KEY},{key(1)})" in plan and f"LessThanOrEqual({LANDING_KEY},{key(2)})" in plan


@pytest.mark.parametrize("land", ["rows", "files"])
def test_lost_checkpoint_after_merges(spark, write_csv, tmp_path, monkeypatch, land):
    monkeypatch.setattr(landing, "add_landed", partial(ledger.add_landed, fan=2))

    def run(checkpoint):
        places = [str(tmp_path / name) for name in ("in", "out", checkpoint)]
        if land == "rows":
            land_rows(spark, places[0], ["Order ID"], *places[1:], max_files=1).awaitTermination()
        else:
            land_files(spark, *places, max_files=1).awaitTermination()
        return rows(read_result(spark, "parquet", path=places[1]), "Order ID")

    for i in range(5):
        write_csv(f"in/{i}.csv", f"Order ID\n{i}\n")
    assert run("first") == [(str(i),) for i in range(5)]
    assert len(folders(tmp_path / "out")) == 2
    write_csv("in/5.csv", "Order ID\n5\n")
    assert run("second") == [(str(i),) for i in range(6)] == run("first")
