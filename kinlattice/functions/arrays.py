"""Arrays and JSON (ARR-01 to ARR-08, JSN-01 to JSN-04)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def append_absent(array: Column, value: Column) -> Column:
    """ARR-01: ``value`` appended unless null or there; a null array counts as empty."""
    a = F.coalesce(array, F.array().cast("array<string>"))
    return F.when(value.isNull() | F.coalesce(F.array_contains(a, value), F.lit(False)), a).otherwise(F.array_append(a, value))


def first_where(array: Column, test: Callable[[Column], Column]) -> Column:
    """ARR-04: the first element that passes, else the first one."""
    return F.coalesce(F.get(F.filter(array, test), F.lit(0)), F.get(array, F.lit(0)))


def first_filled(*columns: Column) -> Column:
    """ARR-06."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def any_of(columns: list[Column], values: list[str]) -> Column:
    """ARR-05: one of many columns holds one of the values."""
    return F.arrays_overlap(F.array(*columns), F.array(*[F.lit(v) for v in values]))


def filled(array: Column) -> Column:
    """ARR-08 and FLT-02: there and not empty; null is false."""
    return F.coalesce(F.size(array) > 0, F.lit(False)) & array.isNotNull()


def dropping_nulls(**parts: Column) -> Column:
    """JSN-03, PRJ-05: JSON object of the parts that are not null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in parts.items()]))


def as_json(**parts: Column) -> Column:
    """JSN-02: JSON object of all parts, nulls kept, in the order given."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in parts.items()]), {"ignoreNullFields": "false"})


def embedded_json(c: Column, marker: str, schema: str) -> Column:
    """JSN-04: the JSON list or object assigned to ``marker`` inside a script; null where it is missing or malformed."""
    raw = F.regexp_extract(c, rf"(?s){marker}\s*[:=]\s*(\[.*?\]|\{{.*?\}})\s*;", 1)
    return F.when(F.try_parse_json(F.nullif(raw, F.lit(""))).isNotNull(), F.from_json(raw, schema))
