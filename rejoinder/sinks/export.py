"""CSV export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rejoinder.functions.fixed import EXPORT_NAME

_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# What makes Spark write fields the way ``pandas.DataFrame.to_csv`` does: quotes
# doubled, blanks kept, empty text and null both written as nothing, microseconds.
EXPORT_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": _TIMESTAMP,
    "timestampNTZFormat": _TIMESTAMP,
}


def export_csv(df: DataFrame, directory: str, name: str = EXPORT_NAME) -> str:
    """Write ``df`` as CSV part files, each with a header, to ``directory/name``
    and return that path. Every task writes its own part."""
    path = f"{directory.rstrip('/')}/{name}"
    texts = {}
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            texts[field.name] = F.when(column, "True").when(~column, "False")
        elif isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
            texts[field.name] = _float_text(column)
    df.withColumns(texts).write.mode("overwrite").options(**EXPORT_OPTIONS).csv(path)
    return path


def _float_text(value: Column) -> Column:
    """A float the way Python prints it: plain digits from 0.0001 up to below 1e16,
    else ``1e-07``; nothing for NaN."""
    text = value.cast("string")  # the JVM turns to exponents below 0.001 and from 1e7
    size = F.abs(value)
    digits = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    return (
        F.when(F.isnan(value), None)
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, F.format_string("e%+03d", exponent)))
    )
