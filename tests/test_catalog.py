import random

import pytest
from pyspark.sql import functions as F

from conftest import utc
from revcat.functions.times import days_before
from revcat.operators.arrivals import each_event, summed
from revcat.plans import health, history, liveness
from revcat.schema import EVENTS
from revcat.sources import files
from revcat.sources import catalog
from revcat.sources.catalog import CatalogTable, Upserted, opened
from revcat.sources.ledger import RunLedger


@pytest.fixture
def table(spark, tmp_path):
    return CatalogTable(spark, str(tmp_path / "catalog"), buckets=2).create()


def content(table, **scan):
    return sorted(tuple(r) for r in table.scan(**scan).collect())


def ids(table, **scan):
    return sorted(r.id for r in table.scan(**scan).select("id").collect())


@pytest.mark.parametrize("bulk", [False, True])
def test_insert_update_keep(table, event, events, bulk):
    first = events([event("a", mag=1.0), event("b", mag=1.0), event("n", updated=None, mag=1.0), event("k", mag=1.0)])
    assert (table.upsert(first).inserted, table.upsert(first, bulk=bulk).inserted) == (4, 0)
    later = "2024-01-10 02:00:00"
    batch = events([
        event("a", updated=later, mag=2.0, source="backfill"),  # newer
        event("b", updated="2024-01-10 00:30:00", mag=2.0),  # older
        event("n", updated=later, mag=2.0),  # stored NULL
        event("k", updated=None, mag=2.0),  # batch NULL
        event("c", mag=2.0),  # new
    ])
    done = table.upsert(batch, bulk=bulk)
    assert (done.inserted, done.updated) == (1, 1)
    rows = {r.id: (r.mag, r.source) for r in table.scan().collect()}
    assert rows == {"a": (2.0, "backfill"), "b": (1.0, "feed"), "n": (1.0, "feed"), "k": (1.0, "feed"), "c": (2.0, "feed")}
    assert table.scan().columns == EVENTS.names


def test_null_is_oldest_option(table, event, events):
    table.upsert(events([event("n", updated=None)]))
    assert table.upsert(events([event("n", mag=9.0)]), null_is_oldest=True).updated == 1


def test_replay_publishes_nothing(table, event, events):
    batch = events([event(f"e{i}") for i in range(20)])
    table.upsert(batch)
    before, versions = content(table), table.versions()
    assert table.upsert(batch) == Upserted(0, 0, 0, versions[-1])
    assert content(table) == before and table.versions() == versions


def test_order_of_batches_does_not_matter(spark, tmp_path, event, events):
    old = events([event(f"e{i}", mag=1.0) for i in range(10)])
    new = events([event(f"e{i}", updated="2024-02-01 00:00:00", mag=2.0) for i in range(5, 15)])
    results = []
    for name, batches in (("x", (old, new)), ("y", (new, old)), ("z", (old, new, old, new))):
        table = CatalogTable(spark, str(tmp_path / name)).create()
        for batch in batches:
            table.upsert(batch)
        results.append(content(table))
    assert results[0] == results[1] == results[2] and len(results[0]) == 15


def test_empty_batch(table, event, events):
    assert table.upsert(events([])).inserted == 0
    table.upsert(events([event("a")]))
    for how in ({}, {"within": "1 day"}, {"bulk": True}):
        done = table.upsert(events([]), **how)
        assert (done.inserted, done.updated, done.slices_written) == (0, 0, 0)


@pytest.mark.parametrize("new_time", ["2024-02-01 00:00:00", "2024-03-15 00:00:00"])
def test_relocated_event_leaves_its_old_month(table, event, events, new_time):
    table.upsert(events([event("a", "2024-01-31 23:59:59"), event("b", "2024-01-20 00:00:00")]))
    done = table.upsert(events([event("a", new_time, updated="2024-05-01 00:00:00")]))
    assert (done.inserted, done.updated) == (0, 1)
    assert ids(table) == ["a", "b"]
    assert ids(table, start="2024-02-01") == ["a"] and ids(table, end="2024-02-01") == ["b"]


def test_month_that_loses_its_last_event(table, event, events):
    table.upsert(events([event("a", "2024-01-31 23:59:59")]))
    table.upsert(events([event("a", "2024-02-01 00:00:00", updated="2024-05-01 00:00:00")]))
    assert ids(table) == ["a"] and {m for m, _ in table.slices()} == {"2024-02"}


def test_within_matches_near_events(table, event, events):
    table.upsert(events([event("a", "2024-01-31 23:59:59"), event("far", "2020-01-01 00:00:00")]))
    batch = events([event("a", "2024-02-01 00:00:01", updated="2024-05-01 00:00:00"), event("b")])
    done = table.upsert(batch, within="1 day")
    near = table._changes(table._placed(batch), table.slices(), "1 day", False, True)
    assert "GreaterThanOrEqual(event_time," in near._jdf.queryExecution().executedPlan().toString()
    assert (done.inserted, done.updated) == (1, 1) and ids(table) == ["a", "b", "far"]


def test_other_slices_are_not_rewritten(table, event, events):
    table.upsert(events([event(f"e{m}{i}", f"2024-{m:02}-10 00:00:00") for m in range(1, 7) for i in range(8)]))
    before = table.slices()
    done = table.upsert(events([event("e30", "2024-03-10 00:00:00", updated="2024-09-01 00:00:00")]))
    changed = {k for k in before if table.slices()[k] != before[k]}
    assert done.slices_written == 1 and len(changed) == 1 and {m for m, _ in changed} == {"2024-03"}


def test_batch_repeats_an_id(table, event, events):
    table.upsert(events([event("a", updated="2024-01-10 01:00:00", mag=1.0), event("a", updated="2024-01-10 03:00:00", mag=3.0)]))
    (row,) = table.scan().collect()
    assert row.mag == 3.0


def test_scan_opens_only_months_in_range(table, event, events):
    table.upsert(events([event(f"e{m}", f"2024-{m:02}-10 00:00:00") for m in range(1, 13)]))
    rows = table.scan("2024-03-01", "2024-04-30")
    assert {f.split("event_month=")[1][:7] for f in rows.inputFiles()} == {"2024-03", "2024-04"}
    assert sorted(r.id for r in rows.collect()) == ["e3", "e4"]
    seasonal = table.scan(calendar_months={2, 3})
    assert {f.split("event_month=")[1][:7] for f in seasonal.inputFiles()} == {"2024-02", "2024-03"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan


def test_questions_open_only_their_months(table, event, events):
    table.upsert(events([event(f"e{y}{m}", f"{y}-{m:02}-10 00:00:00") for y in (2022, 2023) for m in range(1, 13)]))

    def months(frame):
        return {f.split("event_month=")[1][:7] for f in frame.inputFiles()}

    now = "2023-12-10 12:00:00"
    assert months(liveness.recent_pickup_lag(table, now)) == {"2023-12"}
    assert months(history.today_vs_history(table, now)) == {"2022-12", "2023-12"}
    # inputFiles does not list what the baseline's scalar subquery reads.
    assert months(history.hourly_vs_baseline(table, now, baseline_days=60)) == {"2023-12"}
    assert months(opened(table, days_before(now, 60))) == {"2023-10", "2023-11", "2023-12"}


def test_high_water(table, event, events):
    assert table.high_water() is None
    table.upsert(events([event("a", "2024-01-10 00:00:00"), event("b", "2024-02-10 00:00:00.5")]))
    assert table.high_water() == utc("2024-02-10 00:00:00.5")


def test_missing_required_value_fails_whole_batch(table, event, events):
    table.upsert(events([event("a")]))
    with pytest.raises(Exception, match="event_time is NULL"):
        table.upsert(events([event("b"), event("c") | {"event_time": None}]))
    assert ids(table) == ["a"]
    assert files.child_names(table.spark, f"{table.root}/staging") == []


def test_snapshots(spark, table, event, events):
    table.upsert(events([event("a")]))
    table.upsert(events([event("b")]))
    assert ids(table, version=1) == ["a"] and ids(table) == ["a", "b"]
    reopened = CatalogTable(spark, table.root, buckets=7).create()
    assert reopened.buckets == 2 and ids(reopened) == ["a", "b"]
    table.register("live_catalog")
    assert spark.sql("SELECT count(*) FROM live_catalog").first()[0] == 2


@pytest.mark.parametrize("retries", [0, 1])
def test_another_writer_publishes_first(spark, table, event, events, monkeypatch, retries):
    table.upsert(events([event("a")]))
    other, write = CatalogTable(spark, table.root), CatalogTable._write
    pending = [events([event("b")])]

    def interrupted(self, content, attempt):
        if self is table and pending:
            other.upsert(pending.pop())
        return write(self, content, attempt)

    monkeypatch.setattr(CatalogTable, "_write", interrupted)
    if retries:
        assert table.upsert(events([event("c")]), retries=1).inserted == 1
        assert ids(table) == ["a", "b", "c"]
    else:
        with pytest.raises(FileExistsError):
            table.upsert(events([event("c")]), retries=0)
        assert ids(table) == ["a", "b"]


def test_few_ids_reach_the_scan(table, event, events):
    table.upsert(events([event(f"e{i}") for i in range(10)]))
    ids_wanted = events([event("e3"), event("e7")]).select("id")
    found = table._only_ids(table.scan(), ids_wanted)
    assert "PushedFilters: [In(id, [e3,e7])]" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 2


@pytest.mark.parametrize("pushed, broadcast", [(0, 1 << 20), (0, 0)])
def test_batch_too_large_to_push_or_broadcast(table, event, events, monkeypatch, pushed, broadcast):
    monkeypatch.setattr("revcat.sources.catalog.PUSHED_IDS", pushed)
    monkeypatch.setattr("revcat.sources.catalog.BROADCAST_BYTES", broadcast)
    table.upsert(events([event(f"e{i}") for i in range(10)]))
    done = table.upsert(events([event(f"e{i}", updated="2024-02-02 00:00:00") for i in range(5, 15)]))
    assert (done.inserted, done.updated) == (5, 5) and len(ids(table)) == 15


def test_crash_before_publishing_changes_nothing(table, event, events, monkeypatch):
    table.upsert(events([event("a", mag=1.0)]))
    before, batch = content(table), events([event("a", updated="2024-03-01 00:00:00", mag=2.0), event("b")])

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(CatalogTable, "_publish", crash)
        with pytest.raises(OSError):
            table.upsert(batch)
    assert content(table) == before
    assert table.drop_orphans() == 0  # too young
    assert table.drop_orphans(older_than_hours=-1) == 2  # its slices and their sums
    done = table.upsert(batch)
    assert (done.inserted, done.updated) == (1, 1) and ids(table) == ["a", "b"]


def test_expire_keeps_what_is_live(table, event, events):
    table.upsert(events([event(f"e{m}", f"2024-{m:02}-10 00:00:00") for m in range(1, 4)]))
    for day in range(1, 4):
        table.upsert(events([event("e1", "2024-01-10 00:00:00", updated=f"2024-06-0{day} 00:00:00")]))
    before = content(table)
    assert table.expire(keep=1) > 0
    assert content(table) == before and len(table.versions()) == 1
    table.upsert(events([event("z")]))
    assert ids(table) == ["e1", "e2", "e3", "z"]


def test_random_batches_against_a_dictionary(spark, tmp_path, event, events):
    import random

    rng = random.Random(7)
    table, model = CatalogTable(spark, str(tmp_path / "random"), buckets=3).create(), {}
    for step in range(6):
        batch = {}
        for _ in range(40):
            key = f"e{rng.randrange(60)}"
            time = f"2024-{rng.randrange(1, 5):02}-{rng.randrange(1, 28):02} 00:00:00"
            stamp = rng.choice([None, *[f"2024-06-{d:02} 00:00:00" for d in range(1, 20)]])
            batch[key] = event(key, time, stamp, mag=rng.random())
        for key, row in batch.items():
            old = model.get(key)
            newer = old and row["updated"] and old["updated"] and row["updated"] > old["updated"]
            if old is None or newer:
                model[key] = row
        table.upsert(events(list(batch.values())), bulk=bool(step % 2))
    rows = table.scan().select("id", F.unix_micros("event_time"), "mag").collect()
    assert sorted(tuple(r) for r in rows) == sorted(
        (k, int(v["event_time"].timestamp()) * 1_000_000, v["mag"]) for k, v in model.items()
    )


@pytest.mark.parametrize("stored_first", [False, True])
def test_stale_revision_in_an_opened_month_is_ignored(table, event, events, stored_first):
    newer = event("x", "2024-01-02 00:00:00", "2024-06-01 00:00:00", mag=9.0)
    stale = event("x", "2024-01-20 00:00:00", "2024-01-25 00:00:00", mag=1.0)
    other = event("y", "2024-01-20 00:00:00", "2024-01-20 01:00:00", mag=1.0)
    table.upsert(events([newer if stored_first else stale, other]))
    changed = event("y", "2024-01-20 00:00:00", "2024-01-21 00:00:00", mag=2.0)
    done = table.upsert(events([stale if stored_first else newer, changed]), within="20 days")
    assert (done.inserted, done.updated) == (0, 1 if stored_first else 2)
    assert sorted((r.id, r.mag) for r in table.scan().collect()) == [("x", 9.0), ("y", 2.0)]
    again = table.upsert(events([stale, event("y", "2024-01-20 00:00:00", "2024-01-22 00:00:00", mag=3.0)]), within="1 day")
    assert (again.inserted, again.updated) == (0, 1)
    assert sorted((r.id, r.mag) for r in table.scan().collect()) == [("x", 9.0), ("y", 3.0)]


def total(sums):
    return sorted(repr(tuple(r)) for r in summed(sums).collect())


def test_sums_follow_every_upsert(table, event, events, monkeypatch):
    """Rows that change hour, source, month and magnitude, and maxima that move away."""
    monkeypatch.setattr(catalog, "ARRIVAL_FOLDERS", 3)
    r, stored = random.Random(7), 0
    for round_ in range(8):
        rows = [
            event(
                f"e{r.randrange(40)}", f"2024-{r.randint(1, 4):02}-10 00:00:00", f"2024-05-{round_ + r.randint(1, 3):02} 00:00:00",
                mag=r.choice([None, 1.0, 2.5, float("nan")]), source=r.choice(["seed", "feed", None]),
                ingested_at=utc(f"2024-06-{r.randint(1, 28):02} {r.randint(0, 3):02}:30:00"),
            )
            for _ in range(r.choice([0, 6, 25]))
        ]
        done = table.upsert(events(rows))
        stored += done.inserted
        assert done.fetched == len(rows)
        assert total(table.arrivals()) == total(each_event(table.scan()))
        assert len(table._arrival_folders(max(table.versions())) or []) <= 3
    assert table.arrivals().agg(F.sum("events")).first()[0] == stored == table.scan().count()


def test_sums_of_a_snapshot_without_any(spark, table, event, events, monkeypatch):
    table.upsert(events([event("a", source="seed"), event("b", "2024-03-01 00:00:00")]))
    monkeypatch.setattr(CatalogTable, "_arrival_folders", lambda self, version: None)
    assert total(table.arrivals()) == total(each_event(table.scan()))
    table.upsert(events([event("c")]))
    monkeypatch.undo()
    assert total(table.arrivals()) == total(each_event(table.scan())) and table.arrivals().count() >= 2


def test_questions_about_arrivals_do_not_open_events(spark, table, event, events, tmp_path):
    table.upsert(events([event(f"e{m}", f"2024-{m:02}-10 00:00:00") for m in range(1, 13)]))
    table.upsert(events([event("e3", "2024-03-11 00:00:00", updated="2024-09-01 00:00:00", source="backfill")]))
    now = "2024-02-01 00:30:00"
    runs = RunLedger(spark, str(tmp_path / "runs")).read()
    asked = [
        liveness.arrivals_per_hour(table, now), liveness.freshness(table, now), liveness.arrivals_pivot(table, now, ["feed", "backfill"]),
        liveness.source_spans(table), health.health_verdict(table, runs, now),
    ]
    for question in asked:
        opened_files = question.inputFiles()
        assert opened_files and all("/arrivals/v=" in f for f in opened_files)
    hours = {r.source: r.events_written for r in asked[0].collect()}
    assert hours == {"feed": 11, "backfill": 1}
    assert asked[1].first().total_events == 12


def test_expire_removes_unused_sums(spark, table, event, events):
    for day in range(1, 6):
        table.upsert(events([event("a", updated=f"2024-05-0{day} 00:00:00")]))
    before = files.child_names(spark, f"{table.root}/arrivals")
    assert table.drop_orphans(older_than_hours=-1) == 0 and files.child_names(spark, f"{table.root}/arrivals") == before
    table.expire(keep=1)
    assert total(table.arrivals()) == total(each_event(table.scan()))


def test_upsert_reports_its_batch(table, event, events):
    assert table.upsert(events([])).fetched == 0
    table.upsert(events([event("a", "2024-01-01 00:00:00")]))
    batch = [event("a", "2024-01-02 00:00:00"), event("b", "2024-03-01 00:00:00"), event("b", "2024-04-01 00:00:00", updated=None)]
    done = table.upsert(events(batch))
    assert (done.fetched, done.first, done.last) == (3, utc("2024-01-02 00:00:00"), utc("2024-03-01 00:00:00"))


def test_mid_size_batch_filters_the_scan(spark, table, event, events, monkeypatch):
    """Ids too many to broadcast: only rows that a Bloom filter of them lets pass are shuffled."""
    monkeypatch.setattr(catalog, "PUSHED_IDS", 0)
    monkeypatch.setattr(catalog, "BROADCAST_BYTES", 0)
    table.upsert(events([event(f"e{i}", mag=1.0) for i in range(300)]))
    batch = events([event(f"e{i}", updated="2024-03-01 00:00:00", mag=2.0) for i in range(290, 310)])
    measured = {"ids": 20, "least": "e290", "id_bytes": 20 * 68}
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = table._staged(table._placed(batch), f"{table.root}/staging/x")
        with catalog.filtered_scans(spark, measured):
            changes = table._changes(staged, table.slices(), None, False, False, measured)
            plan = changes._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        done = table.upsert(batch)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before["spark.sql.autoBroadcastJoinThreshold"])
    assert (done.inserted, done.updated) == (10, 10)
    assert table.scan().where("mag = 2.0").count() == 20 and table.scan().count() == 310
    assert {k: spark.conf.get(k) for k in before} == before
