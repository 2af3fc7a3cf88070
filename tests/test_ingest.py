import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import utc
from revcat.plans.backfill import land_history, read_landed, read_manifest
from revcat.plans.ingest import decide, feed_snapshot, run_ingest, run_seed
from revcat.sources.catalog import CatalogTable
from revcat.sources.files import child_names, remove
from revcat.sources.ledger import RunLedger, run_status
from revcat.sources.tables import compact, compaction_bins, read_json_lines, read_parquet, write_json_lines, write_parquet

NOW = utc("2024-02-01 00:00:00")


@pytest.fixture
def table(spark, tmp_path):
    return CatalogTable(spark, str(tmp_path / "catalog")).create()


@pytest.fixture
def ledger(spark, tmp_path):
    return RunLedger(spark, str(tmp_path / "runs"))


def land(folder, name, *features):
    folder.mkdir(exist_ok=True)
    rows = [
        {"id": i, "properties": {"time": t and int(t.timestamp() * 1000), "updated": int(u.timestamp() * 1000), "mag": m}}
        for i, t, u, m in features
    ]
    (folder / name).write_text(json.dumps({"type": "FeatureCollection", "features": rows}))


def last(ledger):
    return ledger.read().orderBy(F.col("started_at").desc()).first()


def test_life_of_a_catalog(spark, tmp_path, table, ledger, event, events):
    feed, hour = tmp_path / "feed", dt.timedelta(hours=1)
    archive = events([event(f"old{d}", f"2024-01-{d:02} 00:00:00") for d in range(1, 31)])

    def fetch(start, end):
        return archive.where((F.col("event_time") >= F.lit(start)) & (F.col("event_time") < F.lit(end)))

    def run(number, at, **options):
        return run_ingest(table, ledger, str(feed), fetch, f"run{number}", "sched", as_of=at, **options)

    # Bulk load of the first ten days, then the gap is found and filled.
    seed = str(tmp_path / "seed")
    write_parquet(archive.where("event_time < timestamp'2024-01-10'"), seed)
    assert run_seed(spark, table, ledger, seed, started_at=utc("2024-01-10 00:00:00"))["rows_inserted"] == 9
    got = run(1, NOW)
    assert (got["mode"], got["window_start"], got["status"]) == ("backfill", utc("2024-01-09 00:00:00") - hour, "ok")
    assert (got["rows_fetched"], got["rows_inserted"]) == (22, 21) and table.scan().count() == 30
    assert table.scan().where("source = 'backfill'").count() == 21

    # Recent now: the feed is read; the same feed again changes nothing.
    at = utc("2024-01-30 12:00:00")
    land(feed, "a.json", ("new", at, at, 1.0), ("old30", utc("2024-01-30 00:00:00"), at, 9.0))
    got = run(2, at + hour)
    assert (got["mode"], got["rows_inserted"], got["rows_updated"], got["status"]) == ("feed", 1, 1, "ok")
    got = run(3, at + 2 * hour)
    assert (got["rows_fetched"], got["rows_inserted"], got["rows_updated"], got["status"]) == (2, 0, 0, "no_new_data")

    # A dry run writes nothing.
    land(feed, "b.json", ("dry", at, at, 1.0))
    assert run(4, at + 3 * hour, dry_run=True)["status"] == "dry_run"
    assert table.scan().where("id = 'dry'").count() == 0 and ledger.read().count() == 4

    # A feature without time fails the run, which is recorded; or it is set aside.
    land(feed, "c.json", ("late", None, at, 1.0))
    with pytest.raises(Exception, match="event_time"):
        run(5, at + 4 * hour)
    (failed,) = ledger.read().where("run_id = 'run5'").collect()
    assert (failed.status, failed.rows_fetched, failed.rows_inserted) == ("error", 4, 0)
    assert "event_time is NULL" in failed.error_message and len(failed.error_message) <= 1000
    (feed / "torn.json").write_text('{"features": [{"id"')
    aside = str(tmp_path / "quarantine")
    assert run(6, at + 5 * hour, quarantine=aside)["rows_inserted"] == 1
    assert [(r.id, r.run_id) for r in spark.read.parquet(f"{aside}/rows").collect()] == [("late", "run6")]
    assert [r.file.split("/")[-1] for r in spark.read.parquet(f"{aside}/documents").collect()] == ["torn.json"]
    assert table.scan().count() == 32


def test_decide(table, event, events):
    assert decide(table, NOW) == ("feed", None, None)
    table.upsert(events([event("a", "2023-12-01 00:00:00")]))
    mode, start, end = decide(table, NOW)
    assert (mode, start, end) == ("backfill", utc("2023-11-30 23:00:00"), utc("2023-12-30 23:00:00"))
    assert decide(table, utc("2023-12-01 20:00:00"))[0] == "feed"
    assert decide(table, utc("2023-12-01 20:00:01"))[0] == "backfill"


def test_failed_fetch_is_recorded(table, ledger):
    with pytest.raises(Exception):
        run_ingest(table, ledger, "/nonexistent/feed", None, "r", "sched", as_of=NOW)
    assert (last(ledger).status, last(ledger).mode) == ("error", "feed")


def test_seed_drops_boundary_copies(spark, tmp_path, table, ledger, event, events):
    path = str(tmp_path / "seed")
    write_parquet(events([event("a", mag=1.0), event("b")]), path)
    again = event("a", mag=2.0) | {"ingested_at": utc("2024-02-02 00:00:00")}
    write_parquet(events([again]), path, mode="append")
    run = run_seed(spark, table, ledger, path)
    assert (run["rows_fetched"], run["rows_inserted"], run["mode"], run["status"]) == (3, 2, "seed", "ok")
    assert table.scan().where("id = 'a'").first().mag == 2.0


def test_run_status(spark):
    rows = spark.createDataFrame([(True, 1, 1), (False, 1, 0), (False, 0, 2), (False, 0, 0), (False, None, None)], "f boolean, i int, u int")
    got = [r[0] for r in rows.select(run_status(F.col("f"), F.col("i"), F.col("u"))).collect()]
    assert got == ["error", "ok", "ok", "no_new_data", "no_new_data"]


def test_ledger_opens_only_recent_days(ledger):
    assert ledger.read().count() == 0
    ledger.register("runs_now")
    for day in (1, 2, 3):
        ledger.record({"run_id": f"r{day}", "started_at": utc(f"2024-01-0{day} 10:00:00"), "status": "ok"})
    recent = ledger.read(since="2024-01-02 12:00:00")
    assert [r.run_id for r in recent.collect()] == ["r3"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_resumable_landing(spark, tmp_path, table, ledger, event, events):
    rows = [event(f"e{i}", f"{2020 + i % 3}-{1 + i % 12:02}-{1 + i % 28:02} 0{i % 10}:00:00") for i in range(200)]
    archive, out, manifest = events(rows), str(tmp_path / "raw"), str(tmp_path / "manifest")
    first = land_history(archive, out, manifest, "2023-01-01", cap=20, years=[2021])
    assert {r.start.year for r in first.collect()} == {2021}
    done = land_history(archive, out, manifest, "2023-01-01", cap=20)
    assert done.where("rows <> expected or rows > 20").count() == 0
    assert done.agg(F.sum("rows")).first()[0] == 200 and done.count() == done.select("chunk").distinct().count()
    assert land_history(archive, out, manifest, "2023-01-01", cap=20).count() == done.count()
    assert read_manifest(spark, str(tmp_path / "none")).count() == 0
    landed = spark.read.option("recursiveFileLookup", "true").schema(archive.schema).parquet(out)
    assert landed.count() == 200
    table.upsert(landed, bulk=True)
    assert sorted(r.id for r in table.scan().collect()) == sorted(r["id"] for r in rows)


def test_landing_checks_what_is_listed(spark, tmp_path, event, events):
    """The archive grows inside landed chunks, a folder is lost, a run stops before it lists anything."""

    def some(k):
        return [event(f"e{i}", f"{2020 + i % 3}-{1 + i % 12:02}-{1 + i % 28:02} {i % 24:02}:00:00") for i in range(300) if k(i)]

    out, manifest = str(tmp_path / "raw"), str(tmp_path / "manifest")
    land_history(events(some(lambda i: i % 5)), out, manifest, "2023-01-01", cap=20, years=[2020])
    (first,) = child_names(spark, out)
    land_history(events(some(lambda i: i % 5)), out, manifest, "2023-01-01", cap=20)
    assert len(child_names(spark, out)) == 2  # one folder for all years that were left
    assert len(read_landed(spark, out, manifest).collect()) == 240
    grown = some(lambda i: True)
    land_history(events(grown), out, manifest, "2023-01-01", cap=20)
    before = read_manifest(spark, manifest)
    assert sorted(r.id for r in read_landed(spark, out, manifest).collect()) == sorted(r["id"] for r in grown)
    assert before.where("rows <> expected or rows > 20").count() == 0
    lost = before.where(F.col("run") == first.removeprefix("run=")).count()
    kept = {tuple(r) for r in before.where(F.col("run") != first.removeprefix("run=")).collect()}
    remove(spark, f"{out}/{first}")
    write_parquet(events(grown[:9]), f"{out}/run=unlisted")
    after = land_history(events(grown), out, manifest, "2023-01-01", cap=20)
    assert sorted(r.id for r in read_landed(spark, out, manifest).collect()) == sorted(r["id"] for r in grown)
    assert kept <= {tuple(r) for r in after.collect()} and after.count() >= len(kept) + min(lost, 1)
    # Chunks that still count never overlap.
    ends = sorted((r.start, r.end) for r in after.collect())
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert land_history(events(grown), out, manifest, "2023-01-01", cap=20).count() == after.count()
    late = land_history(events(grown), str(tmp_path / "late"), str(tmp_path / "m2"), "2023-01-01", cap=20, start="2022-02-01")
    assert late.agg(F.sum("rows")).first()[0] == sum(r["event_time"] >= utc("2022-02-01") for r in grown)


def test_compaction_keeps_every_row(spark, tmp_path, event, events):
    source, target = str(tmp_path / "small"), str(tmp_path / "large")
    write_parquet(events([event(f"e{i}") for i in range(90)]).repartition(15), source)
    assert compact(spark, source, target, rows_per_file=40) == 90
    files = read_parquet(spark, target)
    assert len(files.inputFiles()) <= 5 < len(read_parquet(spark, source).inputFiles())
    assert sorted(files.collect()) == sorted(read_parquet(spark, source).collect())


@pytest.mark.parametrize("sizes, bins", [
    ([4, 4, 4, 4], [0, 0, 1, 1]), ([9, 1, 2, 3], [0, 1, 1, 1]), ([1, 1, 8, 2, 2, 1, 5], [0, 0, 0, 1, 1, 1, 2]), ([], []), ([0, 5, 0, 5], [0, 0, 1, 1]),
])
def test_compaction_bins(spark, sizes, bins):
    files = spark.createDataFrame([(f"f{k}", n) for k, n in enumerate(sizes)][::-1], "name string, n int")
    placed = compaction_bins(files, "name", "n", 5).orderBy("name").collect()
    assert [(r.name, r.n, r.bin) for r in placed] == [(f"f{k}", n, b) for k, (n, b) in enumerate(zip(sizes, bins))]


def test_compaction_moves_whole_files(spark, tmp_path, event, events):
    source, target = str(tmp_path / "small"), str(tmp_path / "large")
    for name, n in (("a", 30), ("b", 30), ("c", 70), ("d", 5)):
        write_parquet(events([event(f"{name}{i}") for i in range(n)]).coalesce(1), f"{source}/day={name}")
    assert compact(spark, source, target, rows_per_file=40) == 135
    found = spark.read.parquet(target).groupBy("bin").agg(F.collect_set(F.left("id", F.lit(1))).alias("of")).collect()
    assert {r.bin: sorted(r.of) for r in found} == {0: ["a", "b"], 1: ["c"], 2: ["d"]}


def test_json_lines_strictness(spark, tmp_path, event, events):
    good, bad = tmp_path / "good", tmp_path / "bad"
    write_json_lines(events([event("a") | {"event_time": utc("2024-01-01 00:00:00.123456")}]), str(good))
    (row,) = read_json_lines(spark, str(good)).collect()
    assert row.event_time.microsecond == 123456
    bad.mkdir()
    (bad / "x.json").write_text('{"id":"a","event_time":"2024-01-01T00:00:00Z","mag":"junk","ingested_at":"2024-01-01T00:00:00Z"}\n')
    with pytest.raises(Exception):
        read_json_lines(spark, str(bad)).collect()
    assert read_json_lines(spark, str(bad), on_bad="null").first().mag is None


def test_feed_windows(events, event):
    catalog = events([event("a", "2024-01-31 23:30:00"), event("b", "2024-01-31 12:00:00"), event("c", "2024-01-28 00:00:00"), event("d", "2024-02-02 00:00:00")])
    sizes = {w: feed_snapshot(catalog, NOW, w).count() for w in ("all_hour", "all_day", "all_week", "all_month")}
    assert sizes == {"all_hour": 1, "all_day": 2, "all_week": 3, "all_month": 3}
