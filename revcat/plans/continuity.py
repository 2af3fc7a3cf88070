"""Did it run, and when did it not? Questions to the run ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.functions.numbers import ratio, round_half_away
from revcat.functions.times import instant, whole
from revcat.operators.instants import previous_instant, runs_of
from revcat.session import written

# Verdict texts and the schedule they assume.
FIRST = "first run in window"
ON_SCHEDULE = "on schedule"
LATE = "late (GitHub queue delay)"
GAP = "GAP -- investigate"
RUNS_PER_DAY = 96


def _since(runs: DataFrame, as_of, days: int) -> DataFrame:
    return runs.where(F.col("started_at") >= instant(as_of) - F.expr(f"interval {days} days"))


def run_gaps(
    runs: DataFrame, as_of, days: int = 8, on_schedule_minutes: int = 20, late_minutes: int = 60
) -> DataFrame:
    """Every run with the minutes since the one before and a verdict.

    The step is found between distinct start times; of runs that start at the
    same instant the first by run_id takes the step and the others follow it
    at distance zero.
    """
    window = _since(runs, as_of, days)
    ticks = window.groupBy("started_at").agg(F.min("run_id").alias("first_run_id"))
    steps = previous_instant(written(ticks, "ticks"), "started_at", "previous_tick")
    previous = F.when(F.col("run_id") == F.col("first_run_id"), F.col("previous_tick")).otherwise(
        F.col("started_at")
    )
    minutes = whole("MINUTE", F.col("previous"), F.col("started_at"))
    return (
        window.join(steps, "started_at")
        .withColumn("previous", previous)
        .select(
            "run_id",
            "started_at",
            "status",
            "mode",
            "rows_inserted",
            "rows_updated",
            minutes.alias("minutes_since_previous_run"),
            F.when(F.col("previous").isNull(), FIRST)
            .when(minutes <= on_schedule_minutes, ON_SCHEDULE)
            .when(minutes <= late_minutes, LATE)
            .otherwise(GAP)
            .alias("verdict"),
            "error_message",
        )
        .orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    )


def daily_runs(runs: DataFrame, as_of, days: int = 8, expected: int = RUNS_PER_DAY) -> DataFrame:
    """Per day: runs against the expected number, by outcome, and what they wrote."""
    return (
        _since(runs, as_of, days)
        .groupBy(F.to_date("started_at").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.lit(expected).alias("runs_expected"),
            F.count_if(F.col("status") == "ok").alias("runs_with_new_data"),
            F.count_if(F.col("status") == "no_new_data").alias("runs_quiet"),
            F.count_if(F.col("status") == "error").alias("runs_failed"),
            F.sum("rows_inserted").alias("events_inserted"),
            F.sum("rows_updated").alias("events_revised"),
            round_half_away(F.avg("duration_ms") / 1000, 1).alias("avg_seconds"),
        )
        .orderBy(F.col("day").desc())
    )


def recent_failures(runs: DataFrame, top: int = 50) -> DataFrame:
    failed = runs.where(F.col("status") == "error")
    return (
        failed.orderBy(F.col("started_at").desc(), "run_id")
        .limit(top)
        .select("started_at", "mode", "error_message", "runner_url")
    )


def revising_runs(runs: DataFrame, top: int = 25) -> DataFrame:
    """Newest runs that replaced a stored event by a newer revision."""
    revising = runs.where(F.col("rows_updated") > 0)
    return (
        revising.orderBy(F.col("started_at").desc(), "run_id")
        .limit(top)
        .select("started_at", "mode", "rows_inserted", "rows_updated")
    )


def runs_by_trigger(runs: DataFrame, as_of, days: int = 8) -> DataFrame:
    """Per scheduler: runs, failures, first and last run, minutes since, rows written."""
    return (
        _since(runs, as_of, days)
        .groupBy("trigger")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.count_if(F.col("status") == "error").alias("failures"),
            F.min("started_at").alias("first_run"),
            F.max("started_at").alias("last_run"),
            whole("MINUTE", F.max("started_at"), instant(as_of)).alias("minutes_since_last"),
            F.sum("rows_inserted").alias("events_inserted"),
            F.sum("rows_updated").alias("events_revised"),
        )
        .orderBy(F.col("runs").desc(), "trigger")
    )


def hour_spine(runs: DataFrame, as_of, days: int) -> DataFrame:
    """Every hour of the window that ends at ``as_of``, whether or not anything ran."""
    now = instant(as_of)
    first = F.date_trunc("HOUR", now - F.expr(f"interval {days} days"))
    hours = F.sequence(first, F.date_trunc("HOUR", now), F.expr("interval 1 hour"))
    return runs.sparkSession.range(1).select(F.explode(hours).alias("hour"))


def hourly_runs(runs: DataFrame, as_of, by: str, values: list[str], days: int = 8) -> DataFrame:
    """Runs per hour, one column per value of ``by``; silent hours show as zeros."""
    counted = (
        _since(runs, as_of, days)
        .groupBy(F.date_trunc("HOUR", "started_at").alias("hour"))
        .agg(
            *[F.count_if(F.col(by) == v).alias(v) for v in values],
            F.count(F.lit(1)).alias("total"),
        )
    )
    filled = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in [*values, "total"]]
    return (
        hour_spine(runs, as_of, days).join(counted, "hour", "left").select("hour", *filled)
        .orderBy(F.col("hour").desc())
    )


def delivery_ratio(
    runs: DataFrame, as_of, triggers: list[str], days: int = 8, expected_per_day: int = RUNS_PER_DAY
) -> DataFrame:
    """Per day and scheduler: runs delivered against runs expected, days without any included."""
    now = instant(as_of)
    whole_days = F.sequence(
        F.to_date(now - F.expr(f"interval {days} days")),
        F.to_date(now - F.expr("interval 1 microsecond")),
        F.expr("interval 1 day"),
    )
    spine = runs.sparkSession.range(1).select(F.explode(whole_days).alias("day")).withColumn(
        "trigger", F.explode(F.array(*[F.lit(t) for t in triggers]))
    )
    counted = (
        _since(runs, as_of, days)
        .groupBy(F.to_date("started_at").alias("day"), "trigger")
        .agg(F.count(F.lit(1)).alias("runs"))
    )
    delivered = F.coalesce("runs", F.lit(0).cast("bigint"))
    return spine.join(counted, ["day", "trigger"], "left").select(
        "day",
        "trigger",
        delivered.alias("runs"),
        F.lit(expected_per_day).alias("expected"),
        round_half_away(ratio(delivered, F.lit(expected_per_day)), 3).alias("delivered"),
    )


def uptime_sessions(runs: DataFrame, max_gap: str = "20 minutes", by: Sequence[str] = ()) -> DataFrame:
    """Unbroken stretches of runs, per key (of the same scheduler, for example): (*by, session_start, session_end, runs).

    The rule of the stream's sessions: a run at most ``max_gap`` after the one before it belongs to its session.
    """
    ticks = runs.groupBy(*by, "started_at").agg(F.count(F.lit(1)).alias("n"))
    return runs_of(written(ticks, "ticks"), "started_at", max_gap, "n", by).withColumnRenamed("rows", "runs")
