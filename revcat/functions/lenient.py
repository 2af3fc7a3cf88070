"""Lenient readings of a JSON value kept as VARIANT: junk becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last epoch millisecond of years 1 to 9999.
FIRST_MS, LAST_MS = -62135596800000, 253402300799999


def _kind(value: Column, path: str = "$") -> Column:
    """SQL type name of the JSON value at ``path``; VOID for JSON null, NULL when absent."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def text(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "string")


def real(value: Column, path: str = "$") -> Column:
    """Number or numeric text as double."""
    number = F.try_variant_get(value, path, "double")
    # Java number text may be hexadecimal or end in d or f ("1.5f"); that is junk here.
    java_only = text(value, path).rlike(r"[0-9.][dDfF]\s*$|0[xX]")
    return F.when((_kind(value, path) == "STRING") & java_only, None).otherwise(number)


def integer(value: Column, path: str = "$") -> Column:
    """Integer, integer text, or a number cut toward zero; text with a fraction is junk."""
    return F.try_variant_get(value, path, "bigint")


def instant_of(ms: Column) -> Column:
    """Epoch milliseconds as a UTC instant; out of the calendar's range is junk."""
    return F.when(ms.between(FIRST_MS, LAST_MS), F.timestamp_millis(ms))


def instant_ms(value: Column, path: str = "$") -> Column:
    return instant_of(integer(value, path))


def truthy(value: Column, path: str = "$") -> Column:
    """False for absent, null, 0, "" and empty containers; true otherwise; never NULL."""
    kind = _kind(value, path)
    answer = (
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", text(value, path) != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, path, "boolean"))
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(value, path, "array<variant>")) > 0)
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .otherwise(F.try_variant_get(value, path, "double") != 0)
    )
    return F.coalesce(answer, F.lit(False))
