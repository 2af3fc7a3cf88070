"""The feed as a stream: upserts per micro-batch, and running counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from revcat.operators.normalize import normalize
from revcat.operators.revisions import latest_revision_state
from revcat.schema import split_required
from revcat.sources import files
from revcat.sources.catalog import CatalogTable
from revcat.sources.ledger import RunLedger, utc_now

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None, **more: str):
    """Settings for a stateful query started inside: state in RocksDB, a partition per core.

    A stream's shuffles do not adapt to their size, and their number stays
    fixed for the life of a checkpoint. ``more`` keys use ``_`` for ``.``.
    """
    wanted = {key.replace("_", "."): value for key, value in more.items()} | {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stream_upsert(
    rows: DataFrame,
    table: CatalogTable,
    checkpoint: str,
    ledger: RunLedger | None = None,
    trigger: str = "stream",
    interval: str | None = None,
    then: tuple[str, ...] = (),
    prepare: Callable[[DataFrame, dt.datetime], DataFrame] | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch; one ledger row per batch if a ledger is given.

    State is the table itself, so a revision may arrive any time later. A
    batch delivered twice changes nothing the second time, which makes
    at-least-once delivery enough. A row without a required value stops the
    query, or goes to the ``quarantine`` folder. Without ``interval`` the query
    drains what has landed and stops.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        begun = utc_now()
        if prepare is not None:
            batch = prepare(batch, begun)
        if quarantine is not None:
            batch, bad = split_required(batch)
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        if ledger is None:
            table.upsert(batch, then=then)
            return
        with ledger.run(f"{trigger}-{batch_id}", trigger, started_at=begun) as run:
            run["mode"] = "feed"
            done = table.upsert(batch, then=then)  # the pass that stages the batch also counts it
            run["rows_fetched"], run["rows_inserted"], run["rows_updated"] = done.fetched, done.inserted, done.updated

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    pace = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**pace).start()


def stream_feed(docs: DataFrame, table: CatalogTable, checkpoint: str, source: str = "feed", **options) -> StreamingQuery:
    """Landing feed documents -> catalog."""
    return stream_upsert(
        docs, table, checkpoint, prepare=lambda batch, now: normalize(batch, source, now), **options
    )


class IdleRecorder(StreamingQueryListener):
    """Ledger rows for triggers that found nothing, so that quiet and dead look different.

    Spark reports an idle query about every ten seconds
    (``spark.sql.streaming.noDataProgressEventInterval``); one row is written per
    ``every``, the pace of the scheduled runs, so that a day of silence has no more
    runs than are expected of a day.
    """

    def __init__(self, ledger: RunLedger, trigger: str = "stream", every: dt.timedelta = dt.timedelta(minutes=15)):
        self.ledger, self.trigger, self.every, self.followed = ledger, trigger, every, set()
        self.recorded: dict[str, dt.datetime] = {}

    def follow(self, query: StreamingQuery) -> None:
        self.followed.add(str(query.runId))

    def onQueryIdle(self, event) -> None:
        run, now = str(event.runId), dt.datetime.fromisoformat(event.timestamp)
        if run not in self.followed or (run in self.recorded and now - self.recorded[run] < self.every):
            return
        self.recorded[run] = now
        with self.ledger.run(f"{self.trigger}-idle-{event.timestamp}", self.trigger) as row:
            row["mode"] = "feed"

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.followed.discard(str(event.runId))
        self.recorded.pop(str(event.runId), None)


def suppress_repeats(rows: DataFrame, delay: str = "24 hours", arrival: str = "ingested_at") -> DataFrame:
    """Drop exact re-deliveries of a row seen within ``delay``: equal in every column but the time of ``arrival``.

    Equal revisions that differ in content both come through, so the upsert can take the later
    one. The watermark is on the time of the micro-batch, which no row is ever behind:
    on a time that rows carry it would drop the late ones, though they are new. A
    repeat after ``delay`` comes through, and the upsert ignores it.
    """
    content = F.sha2(F.to_json(F.struct(*[c for c in rows.columns if c != arrival]), {"ignoreNullFields": "false"}), 256)
    timed = rows.withColumns({"seen_at_": F.current_timestamp(), "content_": content}).withWatermark("seen_at_", delay)
    return timed.dropDuplicatesWithinWatermark(["content_"]).drop("seen_at_", "content_")


def latest_state(rows: DataFrame, then: tuple[str, ...] = ()) -> DataFrame:
    """Newest revision per id held as stream state instead of in a table."""
    return latest_revision_state(rows, then=then)


def arrivals(rows: DataFrame, delay: str = "24 hours", width: str = "1 hour") -> DataFrame:
    """Rows written per tumbling window of arrival, by source."""
    return (
        rows.withWatermark("ingested_at", delay)
        .groupBy(F.window("ingested_at", width).alias("w"), "source")
        .agg(F.count(F.lit(1)).alias("events_written"))
        .select(F.col("w.start").alias("ingest_hour"), "source", "events_written")
    )


def sliding_counts(
    rows: DataFrame, width: str = "24 hours", step: str = "1 hour", delay: str = "24 hours", ts: str = "event_time"
) -> DataFrame:
    """Events per window of ``width``, a new window every ``step``."""
    return (
        rows.withWatermark(ts, delay)
        .groupBy(F.window(ts, width, step).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events")
    )


def uptime_sessions(runs: DataFrame, gap: str = "20 minutes", delay: str = "1 day") -> DataFrame:
    """Unbroken stretches of runs per scheduler."""
    return (
        runs.withWatermark("started_at", delay)
        .groupBy(F.session_window("started_at", gap).alias("w"), "trigger")
        .agg(F.count(F.lit(1)).alias("runs"), F.max("started_at").alias("last_run"))
        .select("trigger", F.col("w.start").alias("session_start"), F.col("last_run").alias("session_end"), "runs")
    )


def _drained(result: DataFrame, writer, checkpoint: str) -> StreamingQuery:
    with state_settings(result.sparkSession):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_complete(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an aggregating stream over what has landed; the last complete result as a table."""

    def save(full: DataFrame, batch_id: int) -> None:
        full.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = result.writeStream.outputMode("complete").foreachBatch(save)
    query = _drained(result, writer, checkpoint)
    last = query.lastProgress["batchId"] if query.lastProgress else 0
    return result.sparkSession.read.schema(result.schema).parquet(f"{path}/batch={last}")


def drain_append(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what has landed in append mode; its output as a table."""
    _drained(result, result.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)
    return result.sparkSession.read.schema(result.schema).parquet(path)


def drain_changes(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream that puts out changes over what has landed; all changes as a table.

    Batches without data would go on for ever, as state that expires by the clock waits for them.
    """

    def save(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    spark = result.sparkSession
    writer = result.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    with state_settings(spark, spark_sql_streaming_noDataMicroBatches_enabled="false"):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    layout = T.StructType([*result.schema, T.StructField("batch", T.LongType())])
    if not files.child_names(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)
