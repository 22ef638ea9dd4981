"""Rows out of JSON answers: ``statusCode int, body string``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_WORD = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\b(?:VOID|VARIANT)\b(?!\s*:)|\bDECIMAL\(\d+,\s*\d+\)")
_SQL = {"OBJECT<": "STRUCT<", "VOID": "STRING", "VARIANT": "STRING"}


def _objects(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The objects in the lists of successful answers, one row each, as variants.

    Anything else in a list, and a body that is no list, gives no row.
    """
    # A lone object would be read as a list of one, so ask for a list.
    lists = responses.filter((F.col("statusCode") == 200) & F.ltrim("body").startswith("["))
    elements = lists.select(*keep, F.explode(F.from_json("body", "array<variant>")).alias("record"))
    return elements.filter(F.schema_of_variant("record").startswith("OBJECT<"))


def record_type(responses: DataFrame) -> str | None:
    """The type of a record found over all objects, ``struct<...>``, or ``None`` if
    there is none; one pass. What differs between records is read as text."""
    found = _objects(responses).agg(F.schema_of_variant_agg("record")).first()[0]
    if not found.startswith("OBJECT<"):
        return None
    # Names in back quotes are left alone.
    named = _WORD.sub(lambda m: _SQL.get(m[0], m[0] if m[0][0] == "`" else "DOUBLE"), found)
    return T.DataType.fromDDL(named).simpleString() if "`" not in named else named


def decode_records(responses: DataFrame, record: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per object in the list of every successful answer.

    ``record`` is the type of one record, ``struct<...>``; without it ``record_type``
    looks at all of them first. An answer with another status, broken JSON or a body
    that is no list gives no rows, and what is no object in a list costs only itself.
    ``keep`` names columns of ``responses`` to carry along.
    """
    record = record or record_type(responses)
    if record is None:
        return responses.select(*keep).limit(0)
    parsed = F.from_json(F.to_json("record"), record)
    return _objects(responses, keep).select(*keep, parsed.alias("record")).select(*keep, "record.*")
