"""The run ledger: one appended row per ingest attempt, quiet and failed ones too."""

from __future__ import annotations

import datetime as dt
import time
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revcat.functions.times import instant
from revcat.schema import RUNS, as_nullable, conform
from revcat.sources import files

# Run states.
OK, NO_NEW_DATA, ERROR, DRY_RUN = "ok", "no_new_data", "error", "dry_run"


def run_status(failed: Column, inserted: Column, updated: Column) -> Column:
    """error if failed, ok if anything changed, else no_new_data."""
    changed = (F.coalesce(inserted, F.lit(0)) + F.coalesce(updated, F.lit(0))) > 0
    return F.when(failed, ERROR).when(changed, OK).otherwise(NO_NEW_DATA)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class RunLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, rows: DataFrame) -> None:
        """Append ledger rows, one folder per day of ``started_at``."""
        (
            conform(rows, RUNS)
            .withColumn("run_date", F.to_date("started_at"))
            .write.mode("append")
            .option("compression", "zstd")
            .partitionBy("run_date")
            .parquet(self.root)
        )

    def record(self, run: dict) -> None:
        run = {name: run.get(name) for name in RUNS.names}
        self.append(self.spark.createDataFrame([run], RUNS))

    def read(self, since=None) -> DataFrame:
        """Runs, from ``since`` on; older day folders are not opened."""
        if not files.child_names(self.spark, self.root):
            return self.spark.createDataFrame([], RUNS)
        layout = T.StructType([*as_nullable(RUNS), T.StructField("run_date", T.DateType())])
        rows = self.spark.read.schema(layout).parquet(self.root)
        if since is not None:
            at = instant(since)
            rows = rows.where((F.col("started_at") >= at) & (F.col("run_date") >= F.to_date(at)))
        return rows.select(*RUNS.names)

    def register(self, name: str) -> None:
        """Make the ledger a temporary view for SQL."""
        self.read().createOrReplaceTempView(name)

    @contextmanager
    def run(
        self,
        run_id: str,
        trigger: str,
        runner_url: str | None = None,
        started_at: dt.datetime | None = None,
        dry_run: bool = False,
    ):
        """A run that is recorded however it ends; a dry run is not recorded.

        The body fills the yielded dict (mode, window, rows_*). The status
        follows from the counts unless the body raises, which is recorded as
        an error and raised again.
        """
        begun, clock = started_at or utc_now(), time.monotonic()
        run: dict = {"rows_fetched": 0, "rows_inserted": 0, "rows_updated": 0}
        error = None
        try:
            yield run
        except Exception as raised:
            error = f"{type(raised).__name__}: {raised}"
            raise
        finally:
            took = dt.timedelta(seconds=time.monotonic() - clock)
            error = error or run.get("error_message")
            if dry_run:
                run["status"] = DRY_RUN
            else:
                changed = run["rows_inserted"] or run["rows_updated"]
                run["status"] = ERROR if error else OK if changed else NO_NEW_DATA
            run |= {"run_id": run_id, "trigger": trigger, "runner_url": runner_url, "error_message": error}
            run |= {"started_at": begun, "finished_at": begun + took, "duration_ms": took // dt.timedelta(milliseconds=1)}
            if not dry_run:
                self.record(run)
