"""The present against the past."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.functions.numbers import ratio, round_half_away
from revcat.functions.times import days_before, instant
from revcat.sources.catalog import CatalogTable, opened

BIG = 4.5  # fixed value: magnitude that counts as big


def months_around(as_of: dt.datetime | str) -> set[int]:
    """Calendar months that hold the same day of the year, leap years or not.

    A table scan limited to them answers ``today_vs_history`` from a twelfth of the data.
    """
    return {days_before(as_of, shift).month for shift in (-1, 0, 1)}


def today_vs_history(catalog: CatalogTable | DataFrame, as_of, dense: bool = False) -> DataFrame:
    """One row: today against the same day of the year in earlier years that had events.

    Of a stored table only the months of that time of the year are opened.

    Today is itself a row of that day of the year, so one filtered scan and
    one aggregate per year answer both halves. ``dense`` averages over all
    years since the first one found, silent ones included.
    """
    day = F.to_date(instant(as_of))
    event_day = F.to_date("event_time")
    same_day = opened(catalog, calendar_months=months_around(as_of)).where((F.dayofyear("event_time") == F.dayofyear(day)) & (event_day <= day))
    years = same_day.groupBy(F.year("event_time").alias("year"), (event_day == day).alias("today")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("mag") >= BIG).alias("big"),
        F.max("mag").alias("biggest"),
    )
    today, past = F.col("today"), ~F.col("today")
    totals = years.agg(
        F.coalesce(F.sum(F.when(today, F.col("events"))), F.lit(0)).cast("bigint").alias("events_today"),
        F.coalesce(F.sum(F.when(today, F.col("big"))), F.lit(0)).cast("bigint").alias("m45_plus_today"),
        F.max(F.when(today, F.col("biggest"))).alias("biggest_today"),
        F.sum(F.when(past, F.col("events"))).alias("past_events"),
        F.sum(F.when(past, F.col("big"))).alias("past_big"),
        F.max(F.when(past, F.col("biggest"))).alias("biggest_ever"),
        (F.year(day).cast("bigint") - F.min("year") if dense else F.count_if(past)).alias("years"),
    )
    usual = ratio(F.col("past_events"), F.col("years"))
    return totals.select(
        "events_today",
        round_half_away(usual, 1).alias("avg_events_this_day_of_year"),
        round_half_away(ratio(F.col("events_today"), usual), 2).alias("ratio_vs_normal"),
        "m45_plus_today",
        round_half_away(ratio(F.col("past_big"), F.col("years")), 2).alias("avg_m45_plus"),
        round_half_away(F.col("biggest_today"), 1).alias("biggest_today"),
        round_half_away(F.col("biggest_ever"), 1).alias("biggest_ever_this_day"),
        F.col("years").alias("years_of_history"),
    )


def magnitude_bands(catalog: DataFrame, as_of) -> DataFrame:
    """Events per complete year and magnitude band; a NULL magnitude counts in the total only."""
    mag = F.col("mag")
    return (
        catalog.where(F.col("event_time") < F.date_trunc("YEAR", instant(as_of)))
        .groupBy(F.year("event_time").alias("year"))
        .agg(
            F.count_if(mag < 2).alias("under_m2"),
            F.count_if((mag >= 2) & (mag < 4)).alias("m2_to_m4"),
            F.count_if((mag >= 4) & (mag < 5)).alias("m4_to_m5"),
            F.count_if((mag >= 5) & (mag < 6)).alias("m5_to_m6"),
            F.count_if(mag >= 6).alias("m6_plus"),
            F.count(F.lit(1)).alias("total"),
        )
        .orderBy("year")
    )


def hourly_vs_baseline(
    catalog: CatalogTable | DataFrame, as_of, baseline_days: int = 3650, dense: bool = False
) -> DataFrame:
    """Events of each of the last 24 hours against the average hour of ten years.

    The average is over hours that had events, or with ``dense`` over all
    hours of the baseline. Of a stored table the months from the baseline's
    start on are opened for it, and the last two for the recent hours.
    """
    now, table = instant(as_of), catalog
    catalog = opened(table, days_before(as_of, baseline_days))
    day_ago, begin = now - F.expr("interval 24 hours"), now - F.expr(f"interval {baseline_days} days")
    at, hour = F.col("event_time"), F.date_trunc("HOUR", "event_time").alias("hour")
    recent = opened(table, days_before(as_of, 1)).where(at >= day_ago).groupBy(hour).agg(F.count(F.lit(1)).alias("events_this_hour"))
    hours = catalog.where((at >= begin) & (at < day_ago)).groupBy(hour).agg(F.count(F.lit(1)).alias("n"))
    seen = F.lit(baseline_days * 24 - 24) if dense else F.count(F.lit(1))
    baseline = hours.agg(ratio(F.sum("n"), seen).alias("usual"))
    return (
        recent.withColumn("usual", baseline.scalar())
        .select(
            "hour",
            "events_this_hour",
            round_half_away(F.col("usual"), 1).alias("ten_year_hourly_average"),
            round_half_away(ratio(F.col("events_this_hour"), F.col("usual")), 2).alias("ratio"),
        )
        .orderBy(F.col("hour").desc())
    )
