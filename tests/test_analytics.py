import datetime as dt

import pytest

from conftest import utc
from revcat.plans import continuity, health, history, integrity, liveness
from revcat.schema import RUNS, as_nullable

NOW = utc("2024-01-31 00:00:00")


@pytest.fixture
def ledger(spark):
    def make(*minutes_ago, **rest):
        rows = []
        for i, m in enumerate(minutes_ago):
            started = NOW - dt.timedelta(minutes=m)
            row = dict.fromkeys(RUNS.names) | {"run_id": f"r{i:03}", "started_at": started, "status": "ok", "trigger": "t"}
            rows.append(row | {"rows_inserted": 1, "rows_updated": 0, "duration_ms": 1500} | rest)
        return spark.createDataFrame(rows, as_nullable(RUNS))

    return make


def test_run_gap_verdicts(ledger):
    rows = continuity.run_gaps(ledger(200, 185, 165, 144, 84, 23), NOW).collect()
    got = [(r.minutes_since_previous_run, r.verdict) for r in reversed(rows)]
    assert got == [
        (None, "first run in window"), (15, "on schedule"), (20, "on schedule"), (21, "late (GitHub queue delay)"),
        (60, "late (GitHub queue delay)"), (61, "GAP -- investigate"),
    ]


def test_runs_that_start_together(ledger):
    rows = continuity.run_gaps(ledger(100, 60, 60, 60, 40), NOW).collect()
    assert [r.minutes_since_previous_run for r in reversed(rows)] == [None, 40, 0, 0, 20]


def test_runs_older_than_the_window_are_ignored(ledger):
    rows = continuity.run_gaps(ledger(9 * 1440, 30), NOW).collect()
    assert [r.verdict for r in rows] == ["first run in window"]


def test_hourly_runs_show_silence(ledger):
    rows = continuity.hourly_runs(ledger(30, 45, 150), NOW, "status", ["ok", "error"], days=1).collect()
    assert len(rows) == 25 and sum(r.total for r in rows) == 3
    assert [r.total for r in rows[:4]] == [0, 2, 0, 1] and all(r.error == 0 for r in rows)


def test_delivery_of_a_dead_scheduler(ledger):
    rows = continuity.delivery_ratio(ledger(30, 45), NOW, ["t", "dead"], days=2, expected_per_day=4).collect()
    assert sorted((r.day.day, r.trigger, r.runs, r.delivered) for r in rows) == [
        (29, "dead", 0, 0.0), (29, "t", 0, 0.0), (30, "dead", 0, 0.0), (30, "t", 2, 0.5)
    ]


def test_daily_rollup_of_null_counts(ledger):
    (row,) = continuity.daily_runs(ledger(30, 45, rows_inserted=None), NOW).collect()
    assert (row.runs, row.events_inserted, row.events_revised, row.avg_seconds) == (2, None, 0, 1.5)


def test_health(events, event, ledger):
    fresh = events([event("a") | {"ingested_at": NOW - dt.timedelta(minutes=90, seconds=59)}])
    row = health.health_verdict(fresh, ledger(*range(0, 900, 15)), NOW).first()
    assert (row.age_minutes, row.total_runs, row.verdict) == (90, 60, "healthy")
    stale = events([event("a") | {"ingested_at": NOW - dt.timedelta(minutes=91)}])
    row = health.health_verdict(stale, ledger(10, 20, status="error"), NOW).first()
    assert (row.failed_runs, row.verdict) == (2, "STALE / RUNS BELOW EXPECTED")
    row = health.health_verdict(events([]), ledger(10).where("false"), NOW).first()
    assert (row.age_minutes, row.total_events, row.total_runs, row.stale) == (None, 0, 0, True)


def test_today_without_history(events, event):
    row = history.today_vs_history(events([event("a", "2024-01-31 01:00:00", mag=5.0)]), NOW).first()
    assert (row.events_today, row.m45_plus_today, row.biggest_today, row.ratio_vs_normal) == (1, 1, 5.0, None)
    assert row.years_of_history == 0 and row.avg_events_this_day_of_year is None
    row = history.today_vs_history(events([]), NOW).first()
    assert (row.events_today, row.m45_plus_today, row.years_of_history) == (0, 0, 0)


def test_history_skips_silent_years_unless_dense(events, event):
    days = ["2020-01-31 05:00:00", "2020-01-31 06:00:00", "2022-01-31 05:00:00", "2022-02-01 05:00:00", "2024-01-31 01:00:00"]
    catalog = events([event(f"e{i}", day, mag=float(i)) for i, day in enumerate(days)])
    row = history.today_vs_history(catalog, NOW).first()
    assert (row.avg_events_this_day_of_year, row.years_of_history, row.ratio_vs_normal) == (1.5, 2, 0.67)
    row = history.today_vs_history(catalog, NOW, dense=True).first()
    assert (row.avg_events_this_day_of_year, row.years_of_history) == (0.8, 4)


def test_months_around():
    assert history.months_around("2024-03-01") == {2, 3}
    assert history.months_around(utc("2024-12-31 12:00:00")) == {12, 1}
    assert history.months_around("2023-07-15") == {7}


def test_null_magnitude_is_in_no_band(events, event):
    catalog = events([event("a", "2022-05-05 00:00:00", mag=m) for m in (None, 1.9, 2.0, 4.0, 5.0, 6.0)])
    (row,) = history.magnitude_bands(catalog, NOW).collect()
    assert tuple(row)[1:] == (1, 1, 1, 1, 1, 6)


def test_hourly_baseline_without_history(events, event):
    rows = history.hourly_vs_baseline(events([event("a", "2024-01-30 12:30:00")]), NOW).collect()
    assert [(r.events_this_hour, r.ten_year_hourly_average, r.ratio) for r in rows] == [(1, None, None)]


def test_seam(events, event):
    catalog = events([
        event("a", "2024-01-10 00:00:00", source="seed"), event("b", "2024-01-10 06:00:00", source="seed"),
        event("c", "2024-01-10 05:00:00", source="feed"), event("d", "2024-01-10 16:00:30", source="feed"),
    ])
    row = liveness.seam_check(catalog).first()
    assert (row.seam_minutes, row.overlap_rows, row.longest_silence_seconds) == (-60, 1, 36030)
    only = liveness.seam_check(events([event("a", source="seed")])).first()
    assert (only.seam_minutes, only.overlap_rows, only.longest_silence_seconds) == (None, 0, None)


def test_duplicates(events, event):
    catalog = events([event("a"), event("a"), event("b")])
    assert [tuple(r) for r in integrity.duplicate_ids(catalog).collect()] == [("a", 2)]
    assert tuple(integrity.duplicate_totals(catalog).first()) == (3, 2, 1)


def test_no_python_and_no_cartesian_in_any_plan(events, event, ledger):
    catalog, runs = events([event("a")]), ledger(10, 20)
    plans = [
        liveness.arrivals_per_hour(catalog, NOW), liveness.freshness(catalog, NOW), liveness.recent_pickup_lag(catalog, NOW),
        liveness.seam_check(catalog), continuity.run_gaps(runs, NOW), continuity.uptime_sessions(runs),
        history.today_vs_history(catalog, NOW), history.hourly_vs_baseline(catalog, NOW), health.health_verdict(catalog, runs, NOW),
        integrity.revision_lag(catalog),
    ]
    for frame in plans:
        text = frame._jdf.queryExecution().executedPlan().toString()
        for word in ("Cartesian", "NestedLoop", "Python", "Pandas", "Arrow"):
            assert word not in text
