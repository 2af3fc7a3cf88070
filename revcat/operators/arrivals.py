"""The catalog summed by instant of arrival: all that questions about arrivals need.

A batch arrives at one instant, so the sums have about one row per batch, source
and stored slice, however many events there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVALS = T.StructType(
    [
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("events", T.LongType()),
        T.StructField("biggest_mag", T.DoubleType()),
        T.StructField("oldest_event", T.TimestampType()),
        T.StructField("newest_event", T.TimestampType()),
    ]
)


def each_event(rows: DataFrame, *keys: str) -> DataFrame:
    """Events as sums of one event each, so that a plain DataFrame answers the same questions."""
    return rows.select(
        *keys,
        "ingested_at",
        "source",
        F.lit(1).cast("bigint").alias("events"),
        F.col("mag").alias("biggest_mag"),
        F.col("event_time").alias("oldest_event"),
        F.col("event_time").alias("newest_event"),
    )


def summed(sums: DataFrame, *keys: str) -> DataFrame:
    """Sums added up per instant of arrival and source, and per ``keys``."""
    return sums.groupBy(*keys, "ingested_at", "source").agg(
        F.sum("events").alias("events"),
        F.max("biggest_mag").alias("biggest_mag"),
        F.min("oldest_event").alias("oldest_event"),
        F.max("newest_event").alias("newest_event"),
    )
