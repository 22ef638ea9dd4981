"""Records with line breaks inside quotes: the rows of a read by one task, from many tasks."""

from __future__ import annotations

import gzip
import random
from collections import Counter

import pytest

from rejoinder.sources.csv import scan_csv, scan_csv_by_header
from rejoinder.sources.records import split_records
from tests.conftest import rows

FIELDS = ["", "a", "bc", '"x,y"', '"p\nq"', '"\n\n"', '"he said ""hi""\n, ok"', '""', 'st"ray', " sp ", '"r\r\ns"', "é"]


def well_formed(pick: random.Random) -> str:
    lines = (",".join(pick.choice(FIELDS) for _ in range(pick.choice([3, 3, 3, 2, 4]))) for _ in range(60))
    return "".join(line + pick.choice(["\n", "\n", "\n\n", "\r\n"]) for line in lines)


def with_returns(pick: random.Random) -> str:
    return well_formed(pick).replace("\n", "\r\n").replace("\r\r", "\r")


def wild(pick: random.Random) -> str:
    return "".join(pick.choice('aab",,\n"\n') for _ in range(150))


@pytest.fixture
def split_at(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}

    def set_to(n_bytes: int) -> None:
        spark.conf.set(names[0], str(n_bytes))
        spark.conf.set(names[1], "0")

    yield set_to
    for name in names:
        spark.conf.set(name, before[name])


@pytest.mark.parametrize("made", [well_formed, with_returns, wild])
@pytest.mark.parametrize("n_bytes", [7, 61])
def test_rows_of_one_task(spark, tmp_path, split_at, made, n_bytes):
    path, end = str(tmp_path / "f.csv"), "\r\n" if made is with_returns else "\n"
    with open(path, "w", newline="") as file:
        file.write(f'{end * (n_bytes == 7)}k,"v{end}w",z{end}' + made(random.Random(n_bytes)))
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    wanted = Counter(map(tuple, whole.collect()))
    split_at(n_bytes)
    scanned = scan_csv(spark, path, multi_line=True)
    assert scanned.columns == ["k", "v\nw", "z"]
    assert Counter(map(tuple, scanned.collect())) == wanted


def test_ranges_within_one_value(spark, write_csv, split_at):
    value = 'x\n""y"",\n' * 40
    path = write_csv("v.csv", f'a,b\n1,"{value}"\n2,z\n')
    split_at(16)
    assert sorted(rows(scan_csv(spark, path, multi_line=True))) == [("1", value.replace('""', '"')), ("2", "z")]


def test_open_quote_takes_the_rest(spark, write_csv, split_at):
    path = write_csv("o.csv", 'a,b\n1,"x\n2,y\n3,z')
    split_at(5)
    assert [r.record for r in split_records(spark, path).filter("NOT is_header").collect()] == ['1,"x\n2,y\n3,z']


def test_many_files(spark, tmp_path, split_at):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f'a,b\n{i},"x\ny"\n')
    with gzip.open(tmp_path / "z.csv.gz", "wt") as file:
        file.write('a,b\n9,"x\n"\n')
    (tmp_path / "none.csv").write_text("")
    split_at(6)
    found = sorted(rows(scan_csv(spark, str(tmp_path), multi_line=True)))
    assert found == [("0", "x\ny"), ("1", "x\ny"), ("2", "x\ny"), ("9", "x\n")]


def test_other_header_fails(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "2.csv").write_text('b,a\n"x\ny",1\n')
    with pytest.raises(Exception, match="CSV header does not conform"):
        scan_csv(spark, str(tmp_path), multi_line=True).collect()
    files = [str(tmp_path / name) for name in ("1.csv", "2.csv")]
    assert rows(scan_csv_by_header(spark, files, multi_line=True).select("a", "b")) == [("1", "x\ny")] * 2


def test_header_alone_and_carriage_returns(spark, write_csv):
    assert rows(scan_csv(spark, write_csv("h.csv", "a,b\n"), multi_line=True)) == []
    path = write_csv("r.csv", "")
    with open(path, "w", newline="") as file:
        file.write('a,b\r1,"x\ry"\r2,z\r')
    assert sorted(rows(scan_csv(spark, path, multi_line=True))) == [("1", "x\ny"), ("2", "z")]


def test_plan_shuffles_lines_by_range(spark, write_csv):
    plan = split_records(spark, write_csv("p.csv", "a\n1\n"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" in plan and "SinglePartition" not in plan and "Python" not in plan
