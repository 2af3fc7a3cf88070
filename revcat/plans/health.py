"""One verdict from catalog freshness and recent runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.functions.times import instant, whole
from revcat.plans.liveness import arrived
from revcat.sources.catalog import CatalogTable

# Thresholds and verdict texts.
MAX_AGE_MINUTES = 90
LOW_RUNS = 60
HEALTHY, STALE, LOW_SUFFIX = "healthy", "STALE", " / RUNS BELOW EXPECTED"


def health_verdict(
    catalog: CatalogTable | DataFrame,
    runs: DataFrame,
    as_of,
    max_age_minutes: int = MAX_AGE_MINUTES,
    low_runs: int = LOW_RUNS,
) -> DataFrame:
    """One row: age of the last write, runs of the last 24 hours by outcome, verdict."""
    now = instant(as_of)
    fresh = arrived(catalog).agg(
        F.max("ingested_at").alias("last_write"),
        whole("MINUTE", F.max("ingested_at"), now).alias("age_minutes"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
    )
    recent = runs.where(F.col("started_at") >= now - F.expr("interval 24 hours")).agg(
        F.struct(
            F.count_if(F.col("status") == "ok").alias("ok_runs"),
            F.count_if(F.col("status") == "no_new_data").alias("quiet_runs"),
            F.count_if(F.col("status") == "error").alias("failed_runs"),
            F.count(F.lit(1)).alias("total_runs"),
        )
    )
    stale = F.col("age_minutes").isNull() | (F.col("age_minutes") > max_age_minutes)
    low = F.col("total_runs") < low_runs
    return (
        fresh.withColumn("recent", recent.scalar())
        .select("last_write", "age_minutes", "total_events", "recent.*")
        .withColumn("stale", stale)
        .withColumn("runs_low", low)
        .withColumn(
            "verdict",
            F.concat(F.when(stale, STALE).otherwise(HEALTHY), F.when(low, LOW_SUFFIX).otherwise("")),
        )
    )
