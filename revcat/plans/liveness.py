"""Is data still arriving? Questions to the catalog, as of a given instant."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.functions.numbers import round_half_away
from revcat.functions.times import days_before, instant, utc, whole
from revcat.operators.arrivals import each_event
from revcat.operators.instants import previous_instant
from revcat.session import written
from revcat.sources.catalog import CatalogTable, opened


def arrived(catalog: CatalogTable | DataFrame) -> DataFrame:
    """What came when: of a stored table its sums, of a DataFrame its events."""
    return catalog.arrivals() if isinstance(catalog, CatalogTable) else each_event(catalog)


def arrivals_per_hour(catalog: CatalogTable | DataFrame, as_of, days: int = 3) -> DataFrame:
    """Rows written and biggest magnitude per hour of arrival and source."""
    recent = arrived(catalog).where(F.col("ingested_at") >= instant(as_of) - F.expr(f"interval {days} days"))
    return (
        recent.groupBy(F.date_trunc("HOUR", "ingested_at").alias("ingest_hour"), "source")
        .agg(
            F.sum("events").alias("events_written"),
            round_half_away(F.max("biggest_mag"), 1).alias("biggest_mag"),
        )
        .orderBy(F.col("ingest_hour").desc(), "source")
    )


def freshness(catalog: CatalogTable | DataFrame, as_of) -> DataFrame:
    """One row: last write, newest event, how many minutes each lies back, total."""
    now = instant(as_of)
    return arrived(catalog).agg(
        F.max("ingested_at").alias("last_write"),
        whole("MINUTE", F.max("ingested_at"), now).alias("minutes_since_write"),
        F.max("newest_event").alias("newest_event"),
        whole("MINUTE", F.max("newest_event"), now).alias("minutes_behind"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
    )


def high_water(catalog: CatalogTable | DataFrame) -> DataFrame:
    """One row: the newest event time held, NULL when there is none."""
    return arrived(catalog).agg(F.max("newest_event").alias("latest"))


def recent_pickup_lag(catalog: CatalogTable | DataFrame, as_of, days: int = 2, top: int = 10) -> DataFrame:
    """The newest events and the minutes it took to pick each up; a stored table opens those months only."""
    recent = opened(catalog, days_before(as_of, days)).where(F.col("event_time") >= instant(as_of) - F.expr(f"interval {days} days"))
    return (
        recent.orderBy(F.col("event_time").desc(), "id")
        .limit(top)
        .select(
            "id",
            "event_time",
            round_half_away(F.col("mag"), 1).alias("mag"),
            "place",
            "status",
            "ingested_at",
            whole("MINUTE", F.col("event_time"), F.col("ingested_at")).alias("pickup_lag_minutes"),
        )
    )


def arrivals_pivot(catalog: CatalogTable | DataFrame, as_of, sources: list[str], days: int = 3) -> DataFrame:
    """Rows written per hour of arrival, one column per source."""
    recent = arrived(catalog).where(F.col("ingested_at") >= instant(as_of) - F.expr(f"interval {days} days"))
    of_source = [F.coalesce(F.sum(F.when(F.col("source") == s, F.col("events"))), F.lit(0)).alias(s) for s in sources]
    return (
        recent.groupBy(F.date_trunc("HOUR", "ingested_at").alias("ingest_hour"))
        .agg(*of_source)
        .orderBy(F.col("ingest_hour").desc())
    )


def source_spans(catalog: CatalogTable | DataFrame) -> DataFrame:
    """Rows and time span per source."""
    return arrived(catalog).groupBy("source").agg(
        F.sum("events").alias("events"),
        F.min("oldest_event").alias("first_event"),
        F.max("newest_event").alias("last_event"),
    )


def seam_check(catalog: CatalogTable | DataFrame, bulk: str = "seed", days: int = 1) -> DataFrame:
    """One row on the joint between bulk history and later arrivals.

    ``seam_minutes`` between the last bulk and the first later event,
    ``overlap_rows`` of bulk at or after that first later event, and the
    longest silence between neighbouring events within ``days`` of the seam. A
    stored table gives the ends from its sums and opens the months around the seam.
    """
    later = F.col("source") != bulk
    ends = arrived(catalog).agg(
        F.max(F.when(~later, F.col("newest_event"))).alias("bulk_last"),
        F.min(F.when(later, F.col("oldest_event"))).alias("later_first"),
    )
    # Two instants come to the driver, so the events are a plain pushed-down range.
    found = ends.select(*[F.unix_micros(c).alias(c) for c in ends.columns]).first()
    bulk_last, later_first = (F.timestamp_micros(F.lit(t).cast("bigint")) for t in found)
    margin = F.expr(f"interval {days} days")
    if isinstance(catalog, CatalogTable):
        known = [utc(t) for t in found if t is not None]
        day = dt.timedelta(days=days + 1)
        catalog = catalog.scan(min(known) - day, max(known) + day) if known else catalog.scan()
    near = catalog.where(
        (F.col("event_time") >= F.least(bulk_last, later_first) - margin)
        & (F.col("event_time") <= F.greatest(bulk_last, later_first) + margin)
    )
    # Bulk rows past the seam lie between the two ends, so the span holds them all.
    past_seam = (F.col("source") == bulk) & (F.col("event_time") >= later_first)
    ticks = written(near.groupBy("event_time").agg(F.count_if(past_seam).alias("overlap")), "ticks")
    longest = F.max(F.unix_micros("event_time") - F.unix_micros("previous"))
    silence = previous_instant(ticks, "event_time").agg(
        F.coalesce(F.sum("overlap"), F.lit(0)).cast("bigint").alias("overlap_rows"), longest.alias("longest")
    )
    return silence.select(
        bulk_last.alias("bulk_last"),
        later_first.alias("later_first"),
        whole("MINUTE", bulk_last, later_first).alias("seam_minutes"),
        "overlap_rows",
        F.expr("longest div 1000000").alias("longest_silence_seconds"),
    )
