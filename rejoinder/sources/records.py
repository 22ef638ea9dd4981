"""CSV records with line breaks inside quotes, from files that stay splittable.

Read the usual way such a file is one task's work: where a record ends depends on every quote
before it. Here the lines of each byte range say what they do to the state "inside quotes"
for either state they may start in, ranges sum that up, and the sums, one row per range, are
composed along each file. Then every range knows its state at its start and cuts its own
records; only those that cross into a later range are put together from pieces.

The lines are shuffled once, by range, so no group is larger than a split of the scan.
A record is one row: a quote that is never closed makes the rest of the file one, as in a read by one
task. Empty lines between records are left out. Where the first line of a file ends with a carriage return
before the line feed, it counts as part of every line end that has one, inside quotes too; elsewhere
it belongs to the value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTED = '"(?:[^"]++|"")*+'  # up to the closing quote, or to the end where there is none
_FIELDS = f'(?:(?:{_QUOTED}"[^,]*+|(?!")[^,]*+),)*+'
_OPENS = rf"\A{_FIELDS}{_QUOTED}\z"
_STAYS = rf'\A(?:[^"]++|"")*+(?:\z|"[^,]*+,{_FIELDS}{_QUOTED}\z)'
_RANGE = ["path", "block"]
_NO_OTHER = "__more"


def _after(start: Column | bool, fixed: Column, flips: Column) -> Column:
    """The state after a run of lines: the last one fixed in it, else the state at its start, flipped."""
    state = F.coalesce(fixed["state"], F.lit(start) if isinstance(start, bool) else start)
    return state != (((flips - F.coalesce(fixed["flips"], F.lit(0))) % 2) == 1)


def _steps(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``fixed`` and ``flips`` before and after each row, from what a row does in either state.

    ``from_out`` and ``from_in`` are the states after it. Equal ones fix the state, others
    keep or flip it.
    """
    to_here = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flip = F.expr("cast(from_out AND NOT from_in AS int)")
    rows = rows.withColumn("flips_after", F.sum(flip).over(to_here).cast("long"))
    fixing = F.when(F.expr("from_out = from_in"), F.struct(F.col("from_out").alias("state"), F.col("flips_after").alias("flips")))
    rows = rows.withColumn("fixing", fixing)
    return rows.withColumns({
        "fixed": F.last("fixing", ignorenulls=True).over(before),
        "fixed_after": F.last("fixing", ignorenulls=True).over(to_here),
        "flips": F.col("flips_after") - flip,
    })


def _numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    meta = {"path": "_metadata.file_path", "block": "_metadata.file_block_start"}
    lines = spark.read.option("lineSep", "\n").text(path).select(
        *(F.col(c).alias(name) for name, c in meta.items()), F.monotonically_increasing_id().alias("at"), "value"
    )
    return lines.withColumn("no", F.row_number().over(Window.partitionBy(*_RANGE).orderBy("at")))


def _ranges(lines: DataFrame) -> DataFrame:
    """One row per byte range: its state at start and end, where its first record starts if a
    range before holds the record that it starts in, and the place of the file's header."""
    ends = lines.groupBy(*_RANGE).agg(
        F.max_by(_after(False, F.col("fixed_after"), F.col("flips_after")), "no").alias("from_out"),
        F.max_by(_after(True, F.col("fixed_after"), F.col("flips_after")), "no").alias("from_in"),
        F.min(F.when(F.col("value") != "", F.col("no"))).alias("filled"),
        F.min(F.when(~F.col("value").isin("", "\r"), F.col("no"))).alias("filled_too"),
        F.min_by(F.endswith("value", F.lit("\r")), "no").alias("returns"),
        # A record starts in the range if some line does not begin inside quotes.
        F.bool_or(~F.col("inside_from_out")).alias("starts_from_out"), F.bool_or(~F.col("inside_from_in")).alias("starts_from_in"),
    )
    along = _steps(ends, ["path"], "block")
    along = along.withColumns({
        "inside": _after(False, F.col("fixed"), F.col("flips")), "open": _after(False, F.col("fixed_after"), F.col("flips_after")),
    })
    starts = F.when(F.col("inside"), F.col("starts_from_in")).otherwise(F.col("starts_from_out"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    owner = F.last(F.when(starts, F.col("block")), ignorenulls=True).over(before)
    along = along.withColumns({"owner": owner, "returns": F.min_by("returns", "block").over(whole)})
    along = along.withColumn("filled", F.when(F.col("returns"), F.col("filled_too")).otherwise(F.col("filled")))
    head = F.min(F.when(F.col("filled").isNotNull(), F.struct("block", "filled"))).over(whole)
    return along.select(*_RANGE, F.col("inside").alias("range_inside"), "open", "owner", head.alias("head"), "returns")


def split_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, is_header, record``: every record of the files as text, in no order."""
    lines = _numbered_lines(spark, path)
    lines = lines.withColumns({"from_out": F.col("value").rlike(_OPENS), "from_in": F.col("value").rlike(_STAYS)})
    lines = _steps(lines, _RANGE, "no").withColumns({
        "inside_from_out": _after(False, F.col("fixed"), F.col("flips")), "inside_from_in": _after(True, F.col("fixed"), F.col("flips")),
    })
    both = lines.join(_ranges(lines), _RANGE)
    inside = F.when(F.col("range_inside"), F.col("inside_from_in")).otherwise(F.col("inside_from_out"))
    to_here = Window.partitionBy(*_RANGE).orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("start", F.max(F.when(~inside, F.col("no"))).over(to_here))
    both = both.withColumn("last_start", F.max("start").over(Window.partitionBy(*_RANGE)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "value"))), lambda x: x["value"]), "\n")
    pieces = both.groupBy(*_RANGE, "start").agg(
        text.alias("text"), *(F.first(c).alias(c) for c in ("last_start", "open", "owner", "head", "returns"))
    )
    own, crosses = F.col("start").isNotNull(), F.expr("start <=> last_start AND open")
    is_header = F.expr("head.block = block AND head.filled = start")
    whole = pieces.filter(own & ~crosses).select("path", is_header.alias("is_header"), "returns", "text")
    owner = F.when(own, F.col("block")).otherwise(F.col("owner"))
    parts = pieces.filter(~own | crosses).select("path", owner.alias("owner"), "block", is_header.alias("is_header"), "returns", "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n")
    joined = parts.groupBy("path", "owner").agg(F.bool_or("is_header").alias("is_header"), F.first("returns").alias("returns"), text.alias("text")).drop("owner")
    records = whole.unionByName(joined)
    record = F.when(F.col("returns"), F.regexp_replace("text", r"\r(\n|\z)", "$1")).otherwise(F.col("text"))
    return records.select("path", F.coalesce("is_header", F.lit(False)).alias("is_header"), record.alias("record")).filter("record != ''")


def scan_records(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], checked: bool) -> DataFrame:
    """The records under ``names`` as text. With ``checked`` a file with another header fails,
    and without it one whose lines end with carriage returns alone while others do not."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _NO_OTHER]])
    ddl = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in schema.names)
    parsed = F.from_csv("record", ddl, {"escape": '"', "lineSep": "\n", "multiLine": "true"})
    rows = split_records(spark, path).withColumn("row", parsed)
    found = F.array(*(F.lower(F.col("row").getField(name)) for name in schema.names))
    wanted = F.array(*(F.lower(F.lit(name)) for name in names), F.lit(None).cast("string"))
    if checked:
        fits, problem = found == wanted, "CSV header does not conform to the schema"
    else:
        fits, problem = ~F.col("record").contains("\r"), "carriage returns alone end the lines of a file"
    failing = F.raise_error(F.concat(F.lit(problem + ": "), "path")).cast("boolean")
    data = F.when(~F.col("is_header"), True).when(fits, False).otherwise(failing)
    quoted = (name.replace("`", "``") for name in names)
    return rows.filter(data).select(*(F.col(f"row.`{name}`") for name in quoted))


def ends_lines_otherwise(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether carriage returns alone end the lines of the first file, which is not split then."""
    first = spark.read.option("lineSep", "\n").text(path).select(F.rtrim(F.col("value"), F.lit("\r")).contains("\r").alias("x")).first()
    return bool(first and first.x)
