from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rejoinder.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "rejoinder-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.streaming.metricsEnabled": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every table were large; only what is marked is broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    for name, value in zip(names, ("-1", "0")):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def write_csv(tmp_path):
    """Write text as a file and return its path."""

    def write(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
        return str(path)

    return write


def rows(df, *columns):
    """The rows as sorted tuples, nulls first."""
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
