"""Proof that overlapping re-reads neither duplicate nor lose anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.functions.numbers import round_half_away
from revcat.functions.times import whole


def duplicate_ids(catalog: DataFrame, top: int = 20) -> DataFrame:
    """Ids stored more than once, most copies first; must be empty."""
    copies = catalog.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    return copies.where("copies > 1").orderBy(F.col("copies").desc(), "id").limit(top)


def duplicate_totals(catalog: DataFrame) -> DataFrame:
    """One row: rows, distinct ids, and the difference."""
    return catalog.agg(
        F.count(F.lit(1)).alias("total_rows"), F.countDistinct("id").alias("distinct_ids")
    ).withColumn("duplicates", F.col("total_rows") - F.col("distinct_ids"))


def revision_lag(catalog: DataFrame) -> DataFrame:
    """Per status: events revised, average whole hours and most whole days to the last revision."""
    revised = catalog.where(F.col("updated").isNotNull())
    hours = whole("HOUR", F.col("event_time"), F.col("updated"))
    days = whole("DAY", F.col("event_time"), F.col("updated"))
    return (
        revised.groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("events"),
            round_half_away(F.avg(hours), 1).alias("avg_hours_to_last_revision"),
            F.max(days).alias("max_days_to_last_revision"),
        )
        .orderBy(F.col("events").desc(), "status")
    )
