import json
import time
import types

import pandas as pd
import pytest
from pyspark.sql import types as T

from conftest import utc
from revcat.schema import EVENTS, as_nullable
from revcat.sources.catalog import CatalogTable
from revcat.sources.documents import stream_documents
from revcat.sources.ledger import RunLedger
from revcat.streaming import feeds
from revcat.streaming.newest import _Newest, newest_changes


@pytest.fixture
def table(spark, tmp_path):
    return CatalogTable(spark, str(tmp_path / "catalog"), buckets=2).create()


@pytest.fixture
def landing(spark, tmp_path, events):
    """Add rows as one landed file each time; the stream over them, one file per batch."""
    folder = str(tmp_path / "landing")

    def land(*batches):
        for rows in batches:
            events(rows).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return spark.readStream.schema(as_nullable(EVENTS)).option("maxFilesPerTrigger", 1).parquet(folder)

    return land, stream


def test_stream_equals_batch_across_a_restart(spark, tmp_path, table, landing, event, events):
    land, stream = landing
    first = [event(f"e{i}", mag=1.0) for i in range(10)]
    second = [event(f"e{i}", updated="2024-01-12 00:00:00", mag=2.0) for i in range(5, 15)]
    third = [event("e0", updated="2023-01-01 00:00:00", mag=3.0), event("e1", "2024-03-01 00:00:00", "2024-09-01 00:00:00", mag=3.0)]
    checkpoint = str(tmp_path / "cp")
    land(first, second)
    feeds.stream_upsert(stream(), table, checkpoint).awaitTermination()
    land(third, first)  # the first file delivered again
    feeds.stream_upsert(stream(), table, checkpoint).awaitTermination()
    batch = CatalogTable(spark, str(tmp_path / "batch")).create()
    batch.upsert(events(first + second + third))
    assert sorted(map(tuple, table.scan().collect())) == sorted(map(tuple, batch.scan().collect()))


def test_ledger_row_per_batch_even_when_quiet(spark, tmp_path, table, landing, event):
    land, stream = landing
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    rows = [event("a"), event("b")]
    land(rows, rows)
    feeds.stream_upsert(stream(), table, str(tmp_path / "cp"), ledger=ledger).awaitTermination()
    got = ledger.read().orderBy("run_id").collect()
    assert [(r.run_id, r.status, r.rows_fetched, r.rows_inserted) for r in got] == [
        ("stream-0", "ok", 2, 2), ("stream-1", "no_new_data", 2, 0)
    ]


def test_failed_batch_is_recorded_and_can_be_repeated(spark, tmp_path, table, landing, event):
    land, stream = landing
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    land([event("a"), event("b") | {"event_time": None}])
    with pytest.raises(Exception):
        feeds.stream_upsert(stream(), table, str(tmp_path / "cp"), ledger=ledger).awaitTermination()
    assert [r.status for r in ledger.read().collect()] == ["error"] and table.scan().count() == 0
    aside = str(tmp_path / "aside")
    feeds.stream_upsert(stream(), table, str(tmp_path / "cp"), ledger=ledger, quarantine=aside).awaitTermination()
    assert [r.id for r in table.scan().collect()] == ["a"]
    assert [r.id for r in spark.read.parquet(aside).collect()] == ["b"]


def test_feed_documents_as_a_stream(spark, tmp_path, table):
    folder = tmp_path / "docs"
    folder.mkdir()
    for number, mag in enumerate((1.0, 2.0)):
        properties = {"time": 1_700_000_000_000, "updated": 1_700_000_000_000 + number, "mag": mag}
        (folder / f"{number}.json").write_text(json.dumps({"features": [{"id": "x", "properties": properties}]}))
    docs = stream_documents(spark, str(folder), maxFilesPerTrigger=1)
    feeds.stream_feed(docs, table, str(tmp_path / "cp")).awaitTermination()
    (row,) = table.scan().collect()
    assert (row.mag, row.source) == (2.0, "feed") and row.ingested_at is not None


def test_repeats_are_dropped_across_batches(spark, tmp_path, landing, event):
    land, stream = landing
    at = {"ingested_at": utc("2024-01-10 02:00:00")}
    again = {"ingested_at": utc("2024-01-10 12:00:00")}
    rows = [event("a") | at, event("n", updated=None) | at]
    land(rows, [r | again for r in rows] + [event("a", updated="2024-01-11 00:00:00") | again])
    kept = feeds.suppress_repeats(stream()).select("id", "updated")
    got = feeds.drain_append(kept, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.id for r in got.collect()) == ["a", "a", "n"]


def test_late_arrivals_count_until_the_watermark_passes(spark, tmp_path, landing, event):
    land, stream = landing
    land(
        [event("a") | {"ingested_at": utc("2024-01-10 02:00:00")}],
        [event("b") | {"ingested_at": utc("2024-01-11 01:30:00")}],
        [event("c") | {"ingested_at": utc("2024-01-10 02:30:00")}],  # 23 hours late: counted
        [event("d") | {"ingested_at": utc("2024-01-13 00:00:00")}],
        [event("e") | {"ingested_at": utc("2024-01-13 00:10:00")}],  # closes the windows
        [event("f") | {"ingested_at": utc("2024-01-10 02:40:00")}],  # days late: its window is closed
        [event("g") | {"ingested_at": utc("2024-01-13 00:20:00")}],
    )
    got = feeds.drain_append(feeds.arrivals(stream()), str(tmp_path / "out"), str(tmp_path / "cp")).collect()
    assert sorted((r.ingest_hour.day, r.ingest_hour.hour, r.events_written) for r in got) == [(10, 2, 2), (11, 1, 1)]


def test_state_of_newest_revisions(spark, tmp_path, landing, event):
    land, stream = landing
    land([event("a", mag=1.0)], [event("a", updated="2024-02-01 00:00:00", mag=2.0)], [event("a", updated=None, mag=3.0)])
    newest = feeds.latest_state(stream(), then=("ingested_at",)).select("id", "mag")
    got = feeds.drain_complete(newest, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [tuple(r) for r in got.collect()] == [("a", 2.0)]


def test_idle_triggers_are_recorded(spark, tmp_path, table, landing, event):
    land, stream = landing
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    land([event("a")])
    listener = feeds.IdleRecorder(ledger)
    spark.streams.addListener(listener)
    try:
        query = feeds.stream_upsert(stream(), table, str(tmp_path / "cp"), ledger=ledger, interval="1 second")
        listener.follow(query)
        deadline = 60
        while deadline and ledger.read().where("status = 'no_new_data'").isEmpty():
            query.awaitTermination(1)
            deadline -= 1
        query.stop()
    finally:
        spark.streams.removeListener(listener)
    states = {r.status: r["count"] for r in ledger.read().groupBy("status").count().collect()}
    assert states["ok"] == 1 and states["no_new_data"] >= 1


def test_idle_rows_keep_the_pace_of_runs(spark, tmp_path):
    """One row per quarter of an hour, though the query says that it is idle every ten seconds."""
    ledger = RunLedger(spark, str(tmp_path / "runs"))
    listener = feeds.IdleRecorder(ledger)
    listener.follow(types.SimpleNamespace(runId="q"))
    for query in ("q", "other"):
        for second in range(0, 1900, 300):
            stamp = f"2024-01-01T10:{second // 60:02}:00.000Z"
            listener.onQueryIdle(types.SimpleNamespace(runId=query, timestamp=stamp))
    rows = sorted(r.run_id for r in ledger.read().collect())
    assert rows == [f"stream-idle-2024-01-01T10:{m}:00.000Z" for m in ("00", "15", "30")]


def test_changes_only(spark, tmp_path):
    """Newer revisions come through once per micro-batch; equal, older and missing ones do not."""
    schema = "id string, updated timestamp, n int, `_odd` string"
    day = [utc(f"2024-01-0{k} 00:00:00") for k in range(1, 8)]
    batches = [
        [("a", day[2], 1, "x"), ("a", day[1], 2, "x"), ("b", None, 3, None), (None, day[1], 4, "x")],
        [("a", day[2], 5, "x"), ("a", day[0], 6, "x"), ("b", None, 7, "x"), ("c", day[1], 8, "x")],
        [("a", day[4], 9, "x"), ("a", day[5], 10, "x"), ("b", day[0], 11, "y"), ("c", None, 12, "x")],
    ]
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = feeds.drain_changes(newest_changes(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
        found = sorted((r.id, r.n, r._odd) for r in out.collect())
        seen.append([r for r in found if r not in sum(seen, [])])
    assert seen == [[("a", 1, "x"), ("b", 3, None)], [("c", 8, "x")], [("a", 10, "x"), ("b", 11, "y")]]


def test_state_expires(spark, tmp_path):
    """After its time to live an id counts as new again."""
    rows = spark.createDataFrame([("a", utc("2024-01-01 00:00:00"))], "id string, updated timestamp").coalesce(1)
    emitted = []
    for pause in (0, 0, 4):
        time.sleep(pause)
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        changes = newest_changes(stream, ttl="3 seconds")
        emitted.append(feeds.drain_changes(changes, str(tmp_path / "out"), str(tmp_path / "cp")).count())
    assert emitted[0] == 1 and emitted[-1] > emitted[0]


def test_state_is_kept_for_buckets_of_ids():
    """A bucket's ids come in one group and leave in one frame; an id costs one look and at most one update."""
    looked, state = [], {}

    class Seen:
        def getValue(self, key):
            looked.append(key)
            return state.get(key)

        def updateValue(self, key, value):
            state[key] = value

    handle = types.SimpleNamespace(getMapState=lambda name, key, value, ttlDurationMs: Seen())
    newest = _Newest(["id", "n"], T.StructField("id", T.StringType()), ["v0", "v1"], 1000)
    newest.init(handle)

    def handled(*parts):
        frames = [pd.DataFrame(p, columns=["id", "n", "_version_0", "_version_1", "_bucket"]) for p in parts]
        return [f.values.tolist() for f in newest.handleInputRows((0,), iter(frames), None)]

    assert handled([("a", 1, 5, 0, 0), ("b", 2, 5, 0, 0)], [("a", 3, 5, 1, 0), ("b", 4, 4, 9, 0), ("c", 5, -1, 0, 0)]) == [[["a", 3], ["b", 2], ["c", 5]]]
    assert len(looked) == 3
    assert handled([("a", 6, 5, 1, 0), ("b", 7, 4, 0, 0)]) == []
    assert handled([("a", 8, 6, 0, 0), ("c", 9, -1, 0, 0)]) == [[["a", 8]]]
