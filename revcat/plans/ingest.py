"""The two ingest jobs: the recurring run and the bulk history load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revcat.functions.times import instant, utc
from revcat.operators import ranges
from revcat.operators.normalize import normalize
from revcat.operators.revisions import integrity
from revcat.plans.liveness import high_water
from revcat.schema import conform, split_required
from revcat.sources.catalog import CatalogTable
from revcat.sources.documents import broken_documents, read_documents
from revcat.sources.ledger import ERROR, RunLedger, utc_now
from revcat.sources.tables import read_parquet

# Hours covered by each feed window.
FEED_HOURS = {"all_hour": 1, "all_day": 24, "all_week": 168, "all_month": 720}

Fetch = Callable[[dt.datetime, dt.datetime], DataFrame]


def feed_snapshot(events: DataFrame, as_of, window: str = "all_day") -> DataFrame:
    """What a live feed of the given window holds at ``as_of``."""
    at, hours = instant(as_of), FEED_HOURS[window]
    return events.where(
        (F.col("event_time") > at - F.expr(f"interval {hours} hours")) & (F.col("event_time") <= at)
    )


def decide(table: CatalogTable, as_of: dt.datetime, **limits) -> tuple[str, dt.datetime | None, dt.datetime | None]:
    """(mode, window_start, window_end) of the run that starts at ``as_of``: the first of the windows that catch up."""
    windows = ranges.catchup_windows(high_water(table), as_of, **limits).where("window_no = 0")
    first = windows.select("mode", F.unix_micros("window_start"), F.unix_micros("window_end")).first()
    return (first[0], utc(first[1]), utc(first[2])) if first else ("feed", None, None)


def _set_aside(bad: DataFrame, path: str, run_id: str) -> None:
    bad.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)


def run_ingest(
    table: CatalogTable,
    ledger: RunLedger,
    feed_path: str,
    fetch_range: Fetch,
    run_id: str,
    trigger: str,
    as_of: dt.datetime | None = None,
    dry_run: bool = False,
    quarantine: str | None = None,
    within: str | None = None,
    feed_options: dict | None = None,
    window: str = "all_day",
    **limits,
) -> dict:
    """One recurring run: pick feed or backfill, read, upsert, record.

    ``feed_path`` holds the landed feed documents, of which a run reads those that
    landed within ``window`` (after a longer pause it backfills); ``fetch_range(start, end)``
    returns raw event rows for a backfill. A broken document or a row without
    a required value fails the run, or is noted in the ``quarantine`` folder.
    ``within`` is handed to the upsert, ``feed_options`` to ``read_documents``
    and ``limits`` to ``decide``.
    """
    as_of = as_of or utc_now()
    with ledger.run(run_id, trigger, started_at=as_of, dry_run=dry_run) as run:
        run["mode"], run["window_start"], run["window_end"] = decide(table, as_of, **limits)
        if run["mode"] == "feed":
            since = as_of - dt.timedelta(hours=FEED_HOURS[window])
            options = {"modifiedAfter": f"{since:%Y-%m-%dT%H:%M:%S}"} | (feed_options or {})
            docs = read_documents(table.spark, feed_path, **options)
            if quarantine and not dry_run:
                _set_aside(broken_documents(docs), f"{quarantine}/documents", run_id)
            rows = normalize(docs, "feed", as_of, on_broken="skip" if quarantine else "fail")
        else:
            rows = fetch_range(run["window_start"], run["window_end"])
            rows = conform(rows.withColumns({"source": F.lit("backfill"), "ingested_at": instant(as_of)}))
        fetched = rows = rows.persist()  # read for the count, the side table and the upsert
        try:
            run["rows_fetched"] = rows.count()
            if quarantine and not dry_run:
                rows, bad = split_required(rows)
                _set_aside(bad, f"{quarantine}/rows", run_id)
            if run["rows_fetched"] and not dry_run:
                done = table.upsert(rows, within=within)
                run["rows_inserted"], run["rows_updated"] = done.inserted, done.updated
        finally:
            fetched.unpersist()
    return run


def run_seed(
    spark: SparkSession, table: CatalogTable, ledger: RunLedger, path: str, started_at: dt.datetime | None = None
) -> dict:
    """Bulk load of history files: newest revision, upsert, integrity check, record."""
    started_at = started_at or utc_now()
    with ledger.run(f"seed-{started_at:%Y%m%dT%H%M%S}", "manual", started_at=started_at) as run:
        run["mode"] = "seed"
        rows = read_parquet(spark, path)
        run["rows_fetched"] = rows.count()
        done = table.upsert(rows, bulk=True, then=("ingested_at",))
        run["rows_inserted"], run["rows_updated"] = done.inserted, done.updated
        if not integrity(table.scan()).first()["unique_ids"]:
            run["status"], run["error_message"] = ERROR, "duplicate ids after seed merge"
    return run
