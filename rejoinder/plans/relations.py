"""The given tables, read as orders and returns.

Lineitems with return flag R stand for returns: every order has none, one or
several. The ``keyless`` variants leave the key out where an order is still
pending (status P) or a return still open (line status O), as files do whose rows
have no number yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.functions.fixed import DATE_FORMAT, ORDER_KEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(column: str) -> Column:
    return F.date_format(column, DATE_FORMAT)


def orders(spark: SparkSession, sf_dir: str, keyless: bool = False) -> DataFrame:
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")) if keyless else F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias(ORDER_KEY),
        F.col("o_custkey").alias("Customer ID"),
        _day("o_orderdate").alias("Order Date"),
    )


def returns(spark: SparkSession, sf_dir: str, keyless: bool = False) -> DataFrame:
    key = F.when(F.col("l_linestatus") != "O", F.col("l_orderkey")) if keyless else F.col("l_orderkey")
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(
            key.alias(ORDER_KEY),
            F.col("l_linestatus").alias("Return Reason"),
            _day("l_shipdate").alias("Return Date"),
        )
    )


_ORDERS_SQL = """
SELECT {key} AS "Order ID", o_custkey AS "Customer ID",
       strftime(o_orderdate, '%d-%m-%Y') AS "Order Date"
FROM orders"""

_RETURNS_SQL = """
SELECT {key} AS "Order ID", l_linestatus AS "Return Reason",
       strftime(l_shipdate, '%d-%m-%Y') AS "Return Date"
FROM lineitem WHERE l_returnflag = 'R'"""

_KEYLESS_ORDER = "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END"
_KEYLESS_RETURN = "CASE WHEN l_linestatus <> 'O' THEN l_orderkey END"


def relations_sql(keyless: bool = False) -> str:
    """``o`` and ``r`` as a WITH clause."""
    o = _ORDERS_SQL.format(key=_KEYLESS_ORDER if keyless else "o_orderkey")
    r = _RETURNS_SQL.format(key=_KEYLESS_RETURN if keyless else "l_orderkey")
    return f"WITH o AS ({o}\n), r AS ({r}\n)"


def joined_sql(keyless: bool = False, extra: str = "") -> str:
    """Orders with their returns, rows without a key left out."""
    return f"""{relations_sql(keyless)}
SELECT o."Order ID", o."Customer ID", o."Order Date", r."Return Reason", r."Return Date"{extra}
FROM o LEFT JOIN r ON o."Order ID" = r."Order ID"
WHERE o."Order ID" IS NOT NULL"""
