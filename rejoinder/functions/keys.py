"""Column functions over landing keys and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rejoinder.functions.fixed import LANDING_FORMAT

_LANDING_PATTERN = r"^(\d{8}_\d{6})_(.*)$"


def landing_key(arrived_at: Column, name: Column) -> Column:
    """``<date>_<time>_<name>``: the name under which a file lands."""
    return F.concat(F.date_format(arrived_at, LANDING_FORMAT), F.lit("_"), name)


def landed_at(key: Column) -> Column:
    """The arrival second in a landing key; null where the key has none."""
    return F.try_to_timestamp(F.regexp_extract(key, _LANDING_PATTERN, 1), F.lit(LANDING_FORMAT))


def landed_name(key: Column) -> Column:
    """The file name in a landing key; null where the key is not one."""
    return F.nullif(F.regexp_extract(key, _LANDING_PATTERN, 2), F.lit(""))


def has_suffix(key: Column, suffix: str) -> Column:
    """Case-sensitive test of the end of a name."""
    return key.endswith(suffix)


def file_path(base: str | Column, key: Column) -> Column:
    """``base/key`` with exactly one slash between; null where the key is."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), key)


def is_blank(value: Column) -> Column:
    """Null or empty, the sense in which a request lacks a key."""
    return F.coalesce(value, F.lit("")) == ""
