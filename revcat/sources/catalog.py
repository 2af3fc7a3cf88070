"""The stored catalog: month-partitioned Parquet with an idempotent upsert.

Layout below ``root``::

    data/v=<attempt>/event_month=2024-01/id_bucket=3/*.parquet
    arrivals/v=<attempt>/*.parquet the slices that attempt wrote, summed by instant of arrival
    snapshots/000000000007.json    which attempt holds each live (month, bucket)
    staging/<attempt>/             private to one running upsert

Plain Parquet has no MERGE, and overwriting a partition in place can neither
empty one nor switch several at once. So an upsert rewrites the (month,
bucket) slices it changes to a new attempt folder, then publishes one new
snapshot file. Readers see the old table or the new one, a crashed attempt
leaves only unlisted files, and repeating a batch changes nothing.

Months follow from the data's time span (57 years: 681 months). ``buckets``
splits each month by a hash of id: choose it so that the largest month's
slice is what you are willing to rewrite for one changed row.

Every upsert also sums the slices it wrote, so questions by time of arrival never
open the events. Sums belong to a slice as one attempt wrote it; when the slice is
written again, the new sums take the place of the old ones. So a row that changes its
hour or source leaves its old sum and joins its new one, and maxima stay exact, which
signed differences could not keep when a maximum moves away.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revcat.functions.times import instant, month_key, utc
from revcat.operators.arrivals import ARRIVALS, each_event, summed
from revcat.operators.revisions import latest_revision, outcome
from revcat.schema import EVENTS, as_nullable, conform, enforce_required
from revcat.sources import files

SLICE = ["event_month", "id_bucket"]
BROADCAST_BYTES = 32 << 20  # largest set of batch ids sent to every executor
PUSHED_IDS = 1_000  # largest set of batch ids pushed into the scan as a filter
FILTERED_IDS = 64_000_000  # most batch ids that a Bloom filter is made of
ARRIVAL_FOLDERS = 32  # folders of sums a snapshot lists before they are joined into one


@dataclass(frozen=True)
class Upserted:
    """What an upsert did; ``fetched`` rows came, ``first`` to ``last`` is the time span of the batch."""

    inserted: int = 0
    updated: int = 0
    slices_written: int = 0
    snapshot: int = 0
    fetched: int = field(default=0, compare=False)
    first: dt.datetime | None = field(default=None, compare=False)
    last: dt.datetime | None = field(default=None, compare=False)


class CatalogTable:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 1, schema: T.StructType = EVENTS):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        versions = self.versions()
        self.buckets = self._load(versions[-1])["buckets"] if versions else buckets

    # -- snapshots ---------------------------------------------------------

    def create(self) -> "CatalogTable":
        """Publish an empty table unless there is one."""
        if not self.versions():
            self._publish(0, {}, [])
        return self

    def versions(self) -> list[int]:
        names = files.child_names(self.spark, f"{self.root}/snapshots")
        return [int(n.split(".")[0]) for n in names if not n.startswith(".")]

    def _snapshot(self, version: int) -> str:
        return f"{self.root}/snapshots/{version:012d}.json"

    def _load(self, version: int) -> dict:
        return json.loads(files.read_text(self.spark, self._snapshot(version)))

    def slices(self, version: int | None = None) -> dict[tuple[str, int], str]:
        """Live (month, bucket) -> attempt folder. Small: months times buckets."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return {}
        return {(m, b): attempt for m, b, attempt in self._load(version)["slices"]}

    def _publish(self, version: int, slices: dict, arrivals: list[str]) -> int:
        listed = sorted([m, b, attempt] for (m, b), attempt in slices.items())
        text = json.dumps({"buckets": self.buckets, "slices": listed, "arrivals": arrivals})
        files.publish_text(self.spark, self._snapshot(version), text)
        return version

    def _path(self, month: str, bucket: int, attempt: str) -> str:
        return f"{self.root}/data/v={attempt}/event_month={month}/id_bucket={bucket}"

    # -- reading -----------------------------------------------------------

    def _read(self, slices: dict) -> DataFrame:
        layout = T.StructType(
            [
                *as_nullable(self.schema),
                T.StructField("event_month", T.StringType()),
                T.StructField("id_bucket", T.LongType()),
            ]
        )
        if not slices:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).option("basePath", f"{self.root}/data").parquet(
            *self._paths(slices)
        )

    def _paths(self, slices: dict) -> list[str]:
        """Folders to read: a month's folder where all its buckets are wanted from one attempt."""
        months: dict[tuple[str, str], list[int]] = {}
        for (month, bucket), attempt in sorted(slices.items()):
            months.setdefault((month, attempt), []).append(bucket)
        return [
            path
            for (month, attempt), buckets in months.items()
            for path in (
                [f"{self.root}/data/v={attempt}/event_month={month}"]
                if len(buckets) == self.buckets
                else [self._path(month, bucket, attempt) for bucket in buckets]
            )
        ]

    def scan(
        self, start=None, end=None, version: int | None = None, calendar_months: set[int] | None = None
    ) -> DataFrame:
        """Events with start <= event_time < end; only the months in range are opened.

        ``calendar_months`` opens these months of every year (1 to 12) only,
        for questions about a time of year.
        """
        first, last = _month_of(start) or "", _month_of(end) or "~"
        live = {
            k: v
            for k, v in self.slices(version).items()
            if first <= k[0] <= last and (calendar_months is None or int(k[0][5:]) in calendar_months)
        }
        rows = self._read(live)
        if start is not None:
            rows = rows.where(F.col("event_time") >= instant(start))
        if end is not None:
            rows = rows.where(F.col("event_time") < instant(end))
        return rows.select(*[f.name for f in self.schema])

    def high_water(self) -> dt.datetime | None:
        """Newest event time, read from the newest month only; None when empty."""
        live = self.slices()
        newest = max((month for month, _ in live), default=None)
        rows = self._read({k: v for k, v in live.items() if k[0] == newest})
        return utc(rows.agg(F.unix_micros(F.max("event_time"))).first()[0])

    def arrivals(self) -> DataFrame:
        """Sums per slice, instant of arrival and source; the events are not opened."""
        version = max(self.versions(), default=None)
        if version is None:
            return self.spark.createDataFrame([], ARRIVALS)
        return self._arrivals(self._arrival_folders(version), self.slices(version)).select(*ARRIVALS.names)

    def _arrival_folders(self, version: int) -> list[str] | None:
        """Folders that hold the sums of all live slices; None if an older release wrote the snapshot."""
        return self._load(version).get("arrivals")

    def _arrivals(self, folders: list[str] | None, slices: dict) -> DataFrame:
        """Sums of the given slices as the given attempts wrote them; without folders from the events."""
        # At most months times buckets rows.
        live = self.spark.createDataFrame([(*k, v) for k, v in sorted(slices.items())], "event_month string, id_bucket long, attempt string")
        if folders is None:
            return summed(each_event(self._read(slices), *SLICE), *SLICE).join(F.broadcast(live), SLICE)
        layout = T.StructType([*live.schema, *ARRIVALS])
        if not folders:
            return self.spark.createDataFrame([], layout)
        sums = self.spark.read.schema(layout).parquet(*[f"{self.root}/arrivals/v={f}" for f in folders])
        return sums.join(F.broadcast(live), [*SLICE, "attempt"], "left_semi")

    def register(self, name: str) -> None:
        """Make the current snapshot a temporary view for SQL."""
        self.scan().createOrReplaceTempView(name)

    # -- upkeep ------------------------------------------------------------

    def expire(self, keep: int = 96) -> int:
        """Drop all but the newest ``keep`` snapshots and the files only they use."""
        versions = self.versions()
        gone, kept = versions[:-keep], versions[-keep:]
        used = {item for v in kept for item in self.slices(v).items()}
        unused = {item for v in gone for item in self.slices(v).items()} - used
        for (month, bucket), attempt in sorted(unused):
            files.remove(self.spark, self._path(month, bucket, attempt))
        summed_in = [{f for v in vs for f in self._arrival_folders(v) or []} for vs in (gone, kept)]
        for folder in summed_in[0] - summed_in[1]:
            files.remove(self.spark, f"{self.root}/arrivals/v={folder}")
        for version in gone:
            files.remove(self.spark, self._snapshot(version))
        return len(unused)

    def drop_orphans(self, older_than_hours: float = 48) -> int:
        """Remove what crashed attempts left behind and no snapshot lists.

        The age must exceed the longest upsert, whose files are not listed yet.
        """
        versions = self.versions()
        used = {attempt for v in versions for attempt in [*self.slices(v).values(), *(self._arrival_folders(v) or [])]}
        gone = 0
        for folder, prefix in (("data", "v="), ("arrivals", "v="), ("staging", "")):
            for name, hours in files.child_ages(self.spark, f"{self.root}/{folder}").items():
                if name.startswith(prefix) and name[len(prefix):] not in used and hours > older_than_hours:
                    gone += files.remove(self.spark, f"{self.root}/{folder}/{name}")
        return gone

    # -- writing -----------------------------------------------------------

    def upsert(
        self,
        batch: DataFrame,
        within: str | None = None,
        bulk: bool = False,
        null_is_oldest: bool = False,
        then: tuple[str, ...] = (),
        retries: int = 3,
    ) -> Upserted:
        """Insert new ids; replace a row, all columns, only for a strictly newer revision.

        Stored rows are matched by id wherever they lie in time, so an event
        whose time moved is never duplicated. ``within`` (for example "1 day")
        limits the match to the months of the batch's time span plus that
        margin: cheaper, and right only if event times never move further. ``bulk`` says the
        batch is large, so it is joined as it is instead of being staged and
        measured first. ``then`` breaks ties between equal revisions. If another
        writer publishes first, the batch is applied again to what it published.
        """
        for left in range(retries, -1, -1):
            try:
                return self._upsert_once(batch, within, bulk, null_is_oldest, then)
            except FileExistsError:
                if not left:
                    raise

    def _upsert_once(self, batch, within, bulk, null_is_oldest, then) -> Upserted:
        version = max(self.versions(), default=-1)
        live = self.slices(version) if version >= 0 else {}
        folders = self._arrival_folders(version) if version >= 0 else []
        attempt = uuid.uuid4().hex
        staging = f"{self.root}/staging/{attempt}"
        came, kept_newest = Observation(), Observation()
        newest = latest_revision(batch.observe(came, F.count(F.lit(1)).alias("fetched")), then=then)
        newest = self._placed(newest).observe(kept_newest, *_batch())
        try:
            if not live:
                written = self._write(newest, attempt)
                folders, inserted = self._sum_arrivals(written, {}, [], attempt)
                snapshot = self._publish(version + 1, written, folders)
                return Upserted(inserted, 0, len(written), snapshot, **_measured(came, kept_newest))
            measured = None
            if not bulk:
                newest = self._staged(newest, f"{staging}/batch")
                measured = _counted(kept_newest)
            effect = Observation()
            changes = self._changes(newest, live, within, null_is_oldest, bulk, measured)
            with filtered_scans(self.spark, measured):
                changes = self._staged(changes.observe(effect, *_effect()), f"{staging}/changes")
            touched, inserted, updated = _extent(_counted(effect))
            if not touched:
                return Upserted(snapshot=version, **_measured(came, kept_newest))
            old = {k: v for k, v in live.items() if k in touched}
            columns = [*self.schema.names, *SLICE]
            kept = self._read(old).select(*columns).join(changes.select("id"), "id", "left_anti")
            content = kept.unionByName(changes.select(*columns))
            written = self._write(content, attempt)
            untouched = {k: v for k, v in live.items() if k not in touched}
            folders, _ = self._sum_arrivals(written, untouched, folders, attempt)
            snapshot = self._publish(version + 1, {**untouched, **written}, folders)
            return Upserted(inserted, updated, len(written), snapshot, **_measured(came, kept_newest))
        except FileExistsError:
            files.remove(self.spark, f"{self.root}/data/v={attempt}")
            files.remove(self.spark, f"{self.root}/arrivals/v={attempt}")
            raise
        finally:
            files.remove(self.spark, staging)

    def _sum_arrivals(self, written: dict, untouched: dict, folders: list[str] | None, attempt: str) -> tuple[list[str], int]:
        """Sum the slices just written; returns the folders that hold all live sums, and the events summed.

        Old folders stay as they are until there are many, and then join the new one.
        """
        sums = self._arrivals(None, written)
        if folders is None or len(folders) >= ARRIVAL_FOLDERS:
            sums, folders = sums.unionByName(self._arrivals(folders, untouched)), []
        total = Observation()
        sums = sums.observe(total, F.sum("events").alias("events"))
        path = f"{self.root}/arrivals/v={attempt}"
        sums.sortWithinPartitions("ingested_at").write.option("compression", "zstd").parquet(path)
        return [*folders, attempt], _counted(total).get("events") or 0

    def _placed(self, rows: DataFrame) -> DataFrame:
        placed = enforce_required(conform(rows, self.schema), self.schema)
        return placed.withColumn("event_month", month_key(F.col("event_time"))).withColumn(
            "id_bucket", F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("bigint")
        )

    def _staged(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(as_nullable(rows.schema)).parquet(path)

    def _changes(self, newest, live, within, null_is_oldest, bulk, measured: dict | None = None) -> DataFrame:
        """Batch rows that insert or update, with the month they leave."""
        near = F.lit(True)
        if within is not None:
            ends = measured or newest.agg(*_batch()).first().asDict()
            if ends.get("first") is not None:
                margin = F.expr(f"interval {within}")
                low, high = self.spark.range(1).select(
                    F.unix_micros(F.timestamp_micros(F.lit(ends["first"])) - margin),
                    F.unix_micros(F.timestamp_micros(F.lit(ends["last"])) + margin),
                ).first()
                first, last = _month_of(utc(low)), _month_of(utc(high))
                # Whole months: a slice is rewritten whole, so all its rows must be matched.
                live = {k: v for k, v in live.items() if first <= k[0] <= last}
                months = [F.date_trunc("MONTH", F.timestamp_micros(F.lit(t))) for t in (low, high)]
                near = (F.col("event_time") >= months[0]) & (F.col("event_time") < months[1] + F.expr("interval 1 month"))
        stored = self._read(live).where(near).select(
            "id",
            F.col("id").alias("stored_id"),
            F.col("updated").alias("stored_updated"),
            F.col("event_month").alias("old_month"),
        )
        if not bulk:
            stored = self._only_ids(stored, newest.select("id"), measured)
        verdict = outcome(F.col("stored_id"), F.col("updated"), F.col("stored_updated"), null_is_oldest)
        joined = newest.join(stored, "id", "left").withColumn("outcome", verdict)
        return joined.where("outcome <> 'keep'").drop("stored_id", "stored_updated")

    def _only_ids(self, stored: DataFrame, ids: DataFrame, measured: dict | None = None) -> DataFrame:
        """Cut the stored rows to the batch's ids without shuffling the table.

        A few ids go into the scan as a filter: files are ordered by id, so
        Parquet skips the pages that cannot hold them. More are broadcast, if
        their measured size allows. Still more meet in a shuffle, of which a Bloom filter
        of the ids (``filtered_scans``) spares the rows that cannot match; the bound on the
        ids, which leaves none out, is what makes the optimizer consider one.
        """
        measured = measured if measured is not None else ids.agg(*_ids()).first().asDict()
        if measured.get("ids", 0) <= PUSHED_IDS:
            return stored.where(F.col("id").isin([r.id for r in ids.collect()]))
        if measured["id_bytes"] <= BROADCAST_BYTES:
            return stored.join(F.broadcast(ids), "id", "left_semi")
        if measured["ids"] <= FILTERED_IDS:
            return stored.join(ids.where(F.col("id") >= F.lit(measured["least"])), "id", "left_semi")
        return stored

    def _write(self, content: DataFrame, attempt: str) -> dict:
        """Write whole slices; returns those that have rows.

        The rebalance hint lets the runtime split a slice far larger than the
        others over several tasks. A slice left without rows is not written
        and so drops out of the snapshot.
        """
        target = f"{self.root}/data/v={attempt}"
        (
            content.hint("rebalance", *SLICE)
            .sortWithinPartitions(*SLICE, "id")
            .write.partitionBy(*SLICE)
            .option("compression", "zstd")
            .parquet(target)
        )
        return {
            (month.split("=")[1], int(bucket.split("=")[1])): attempt
            for month in files.child_names(self.spark, target)
            if month.startswith("event_month=")
            for bucket in files.child_names(self.spark, f"{target}/{month}")
            if bucket.startswith("id_bucket=")
        }


def opened(catalog: CatalogTable | DataFrame, start=None, calendar_months: set[int] | None = None) -> DataFrame:
    """What a question has to read: of a table only the months named, a DataFrame as it is."""
    return catalog.scan(start, calendar_months=calendar_months) if isinstance(catalog, CatalogTable) else catalog


def _ids() -> list:
    return [
        F.count(F.lit(1)).alias("ids"),
        F.min("id").alias("least"),
        F.sum(F.octet_length("id") + F.lit(64)).alias("id_bytes"),
    ]


@contextmanager
def filtered_scans(spark: SparkSession, measured: dict | None):
    """Lets a scan be filtered by the ids of a batch too large to broadcast, for queries planned inside."""
    ids = (measured or {}).get("ids", 0)
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    wanted = {
        f"{prefix}.enabled": "true",
        f"{prefix}.applicationSideScanSizeThreshold": "0",
        f"{prefix}.creationSideThreshold": str(64 * FILTERED_IDS),
        f"{prefix}.expectedNumItems": str(max(1, ids)),
        f"{prefix}.maxNumItems": str(FILTERED_IDS),
        f"{prefix}.maxNumBits": str(8 * FILTERED_IDS),
    }
    if not 0 < ids <= FILTERED_IDS or measured["id_bytes"] <= BROADCAST_BYTES:
        wanted = {}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _batch() -> list:
    """What the pass that stages a batch counts on the way."""
    return [
        *_ids(),
        F.min(F.unix_micros("event_time")).alias("first"),
        F.max(F.unix_micros("event_time")).alias("last"),
    ]


def _effect() -> list:
    """What the pass that stages the changes counts: outcomes, and slices entered or left (months times buckets)."""
    return [
        F.count_if(F.col("outcome") == "insert").alias("inserted"),
        F.count_if(F.col("outcome") == "update").alias("updated"),
        F.collect_set(F.struct("event_month", "id_bucket")).alias("entered"),
        F.collect_set(F.when(F.col("old_month").isNotNull(), F.struct("old_month", "id_bucket"))).alias("left"),
    ]


def _counted(observation: Observation) -> dict:
    """What was counted; nothing where the optimizer found the counted branch empty and cut it off."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def _measured(came: Observation, newest: Observation) -> dict:
    ends = _counted(newest)
    return {"fetched": _counted(came).get("fetched", 0), "first": utc(ends.get("first")), "last": utc(ends.get("last"))}


def _extent(effect: dict) -> tuple[set, int, int]:
    touched = {tuple(s) for s in [*effect.get("entered", []), *effect.get("left", [])]}
    return touched, effect.get("inserted", 0), effect.get("updated", 0)


def _month_of(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc)
    return f"{value:%Y-%m}"
