"""Rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, places: int) -> Column:
    """Round half away from zero on the decimal form, so 0.285 gives 0.29.

    Values a decimal(38,8) cannot hold are left as they are: NaN, infinities, and
    doubles so large that they have no decimals.
    """
    as_decimal = value.try_cast("decimal(38,8)")
    return F.coalesce(F.round(as_decimal, places).cast("double"), value.cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """True division; NULL for a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
