"""The same results in plain SQL, for an independent engine over the driver's tables."""

from __future__ import annotations

from checks import views as V
from checks.documents import AGAIN, JUNK, NO_ID, NO_TIME, PAGE, SHORT
from revcat.schema import EVENTS, required

ORACLES: dict[str, str] = {}

CATALOG, HISTORY, LEDGER = (V.duck(t) for t in (V.CATALOG, V.HISTORY, V.LEDGER))
NOW, HISTORY_NOW = (f"timestamp '{t}'" for t in (V.CATALOG_AS_OF, V.HISTORY_AS_OF))
COLUMNS = V.EVENT_COLUMNS


def oracle(name: str, sql: str, **views: str) -> None:
    """Register ``sql`` with the given derived views in front."""
    ctes = [f"{alias} AS ({text})" for alias, text in views.items()]
    if sql.lstrip().upper().startswith("WITH "):
        body = sql.lstrip()[5:]
        recursive = body.upper().startswith("RECURSIVE ")
        body = body[10:] if recursive else body
        head = "WITH RECURSIVE " if recursive else "WITH "
        ORACLES[name] = head + ", ".join([*ctes, body])
    else:
        ORACLES[name] = ("WITH " + ", ".join(ctes) + " " if ctes else "") + sql


def rounded(expression: str, places: int) -> str:
    return f"CAST(round(CAST({expression} AS decimal(20,8)), {places}) AS double)"


def nulls(schema, names: str) -> str:
    """The columns of EVENTS, those not in ``names`` as typed NULLs."""
    have = {n.strip() for n in names.split(",")}
    types = {"string": "varchar", "timestamp": "timestamp", "double": "double", "boolean": "boolean", "bigint": "bigint"}
    return ", ".join(
        f.name if f.name in have else f"CAST(NULL AS {types[f.dataType.simpleString()]}) AS {f.name}" for f in schema
    )


HISTORY_ROW = nulls(EVENTS, "id, event_time, updated, mag, status, source, ingested_at")

# -- sources and sinks -------------------------------------------------------

oracle(
    "feed_snapshot",
    f"SELECT {COLUMNS} FROM c WHERE event_time > {NOW} - interval '24' hour AND event_time <= {NOW}",
    c=CATALOG,
)
oracle(
    "range_scan",
    f"SELECT {HISTORY_ROW} FROM h WHERE event_time >= timestamp '1998-03-15' AND event_time < timestamp '1998-05-02'",
    h=HISTORY,
)
oracle(
    "range_counts",
    """
    SELECT r.o_custkey, r."start", r."end",
      (SELECT count(*) FROM h WHERE h.event_time >= r."start" AND h.event_time < r."end") AS events
    FROM (SELECT o_custkey, min(event_time) AS "start", max(event_time) AS "end" FROM h GROUP BY o_custkey) AS r
    """,
    h=HISTORY,
)
for trip in ("parquet_roundtrip", "jsonl_roundtrip"):
    oracle(trip, f"SELECT {COLUMNS} FROM c", c=CATALOG)
oracle(
    "bulk_load",
    "SELECT date_trunc('month', event_time) AS month, count(*) AS loaded_rows, count(DISTINCT id) AS distinct_ids"
    " FROM f GROUP BY 1",
    f=V.duck(V.CHUNK_FILES),
)
oracle(
    "chunk_overlap_dedupe",
    """
    SELECT id, event_time, updated, mag, ingested_at FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated DESC, ingested_at DESC) AS k FROM f
    ) AS ranked WHERE k = 1
    """,
    f=V.duck(V.CHUNK_FILES),
)
oracle(
    "month_scan",
    "SELECT id, event_time, mag, status FROM h WHERE event_time >= timestamp '1996-02-10'"
    " AND event_time < timestamp '1996-04-20 12:00:00'",
    h=HISTORY,
)
oracle(
    "partition_profile",
    "SELECT strftime(event_time, '%Y-%m') AS event_month, count(*) AS events, count(DISTINCT id) AS ids"
    " FROM h GROUP BY 1",
    h=HISTORY,
)


def laid(source: str, view: str, rows: int) -> str:
    """One file after the other: the next bin begins after the file that fills the last one."""
    return f"""RECURSIVE files AS (
      SELECT {source} AS source, row_number() OVER (ORDER BY {source}) AS k, count(*) AS n,
        min(event_time) AS earliest, max(event_time) AS latest
      FROM {view} GROUP BY 1
    ),
    laid AS (
      SELECT *, CAST(0 AS bigint) AS bin, n AS filled FROM files WHERE k = 1
      UNION ALL
      SELECT files.*, bin + CASE WHEN filled >= {rows} THEN 1 ELSE 0 END,
        files.n + CASE WHEN filled >= {rows} THEN 0 ELSE filled END
      FROM laid JOIN files ON files.k = laid.k + 1
    )"""


oracle("ledger_append", "SELECT * FROM r WHERE started_at >= timestamp '2024-01-10 06:00:00'", r=LEDGER)
oracle(
    "compact_plan",
    f"""
    WITH {laid("strftime(event_time, '%Y-%m-%d')", "h", 500)}
    SELECT bin, count(*) AS files, CAST(sum(n) AS bigint) AS rows, min(source) AS first, max(source) AS last
    FROM laid GROUP BY bin
    """,
    h=HISTORY,
)
oracle(
    "compact_layout",
    f"""
    WITH {laid("chunk_start", "f", 4000)}
    SELECT bin, CAST(sum(n) AS bigint) AS rows, min(earliest) AS first, max(latest) AS last FROM laid GROUP BY bin
    """,
    f=V.duck(V.CHUNK_FILES),
)

# -- normalization -----------------------------------------------------------

DELIVERED = f"""
SELECT *, 0 AS copy FROM ({CATALOG}) AS c
UNION ALL
SELECT * REPLACE (updated - interval '1' hour AS updated, 'stale' AS status), 1 AS copy
FROM ({CATALOG}) AS c WHERE event_id % {AGAIN} = 0
"""
oracle(
    "flatten_features",
    f"""
    SELECT event_id // {PAGE} AS page, count(*) AS features,
      count(*) FILTER (WHERE event_id % {NO_ID} <> 0) AS with_id, count(*) - 1 AS last_position
    FROM d GROUP BY 1
    """,
    d=DELIVERED,
)


def millis(column: str) -> str:
    return f"date_trunc('millisecond', {column})"


# Two deliveries tie only if both lack a revision; then the later one, the copy, wins.
NORMALIZED = f"""
SELECT * REPLACE (
  CASE WHEN event_id % {NO_TIME} <> 0 THEN {millis("event_time")} END AS event_time,
  {millis("updated")} AS updated,
  CASE WHEN event_id % {JUNK} <> 0 THEN mag END AS mag,
  CASE WHEN event_id % {SHORT} <> 0 THEN depth_km END AS depth_km,
  CASE WHEN event_id % {AGAIN} = 0 AND updated IS NULL THEN 'stale' ELSE status END AS status,
  'feed' AS source, {NOW} AS ingested_at)
FROM ({CATALOG}) AS c WHERE event_id % {NO_ID} <> 0
"""
oracle("normalize", f"SELECT {COLUMNS} FROM n", n=NORMALIZED)
oracle("stream_feed_documents", f"SELECT {COLUMNS} FROM n WHERE event_time IS NOT NULL", n=NORMALIZED)
oracle(
    "conform_report",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE "
        + (f"event_id % {NO_TIME} = 0" if name == "event_time" else f"{name} IS NULL")
        + f") AS null_rows FROM d WHERE event_id % {NO_ID} <> 0"
        for name in required(EVENTS)
    ),
    d=DELIVERED,
)
oracle(
    "lenient_cast",
    """
    SELECT event_id,
      CASE event_id % 14 WHEN 0 THEN event_id WHEN 2 THEN event_id WHEN 3 THEN -event_id WHEN 4 THEN 1
        WHEN 7 THEN 0 WHEN 8 THEN 0 WHEN 12 THEN 0 WHEN 13 THEN event_id END AS as_int,
      CAST(CASE event_id % 14
        WHEN 0 THEN CAST(concat(CAST(event_id AS varchar), '.9') AS double)
        WHEN 1 THEN CAST(concat(CAST(event_id AS varchar), '.9') AS double)
        WHEN 2 THEN event_id
        WHEN 3 THEN CAST(concat('-', CAST(event_id AS varchar), '.9') AS double)
        WHEN 4 THEN 1 WHEN 7 THEN 0 WHEN 8 THEN 0 WHEN 12 THEN 0 WHEN 13 THEN event_id END AS double) AS as_real,
      CASE event_id % 14 WHEN 5 THEN false WHEN 6 THEN false WHEN 7 THEN false WHEN 10 THEN false
        WHEN 12 THEN false WHEN 13 THEN event_id <> 0 ELSE true END AS as_bool,
      CASE event_id % 5 WHEN 1 THEN timestamp '1970-01-01' - event_id * interval '1' millisecond
        WHEN 2 THEN timestamp '1970-01-01' + event_id * interval '1' second
        WHEN 4 THEN timestamp '1970-01-01' + event_id * interval '1' second END AS as_instant
    FROM events
    """,
)


def iso(column: str) -> str:
    return (
        f"CASE WHEN epoch_us({column}) % 1000000 = 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S+00:00')"
        f" ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
    )


oracle(
    "iso_format",
    f"SELECT id, {iso('event_time')} AS event_time_text, {iso('ingested_at')} AS ingested_at_text,"
    " strftime(updated, '%Y-%m-%dT%H:%M:%S') AS updated_seconds FROM c",
    c=CATALOG,
)

# -- revisions and upsert ----------------------------------------------------


def newest(view: str, order: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS k"
        f" FROM {view}) AS ranked WHERE k = 1"
    )


REVISED = "id, updated, ingested_at, position, mag"
oracle(
    "latest_revision",
    newest("v", "updated DESC NULLS LAST, position DESC", REVISED),
    v=V.duck(V.REVISIONS),
)
oracle(
    "latest_revision_ties",
    newest("v", "updated DESC NULLS LAST, position DESC", "id, updated, position, mag"),
    v=V.duck(V.TIED_REVISIONS),
)
for rank in ("latest_revision_window", "stream_latest", "stream_changes"):
    oracle(
        rank,
        newest("v", "updated DESC NULLS LAST, ingested_at DESC, position DESC", REVISED),
        v=V.duck(V.REVISIONS),
    )

SIDES = {
    "t": V.duck(V.TARGET),
    "b": newest(f"({V.duck(V.BATCH)}) AS raw", "updated DESC NULLS LAST, position DESC", COLUMNS),
}
oracle(
    "merge_probe",
    """
    SELECT count(*) FILTER (WHERE t.id IS NULL) AS to_insert,
      count(*) FILTER (WHERE b.updated > t.updated) AS to_update,
      min(b.event_time) AS min_time, max(b.event_time) AS max_time
    FROM b LEFT JOIN t ON b.id = t.id
    """,
    **SIDES,
)
oracle(
    "upsert_probe",
    f"""
    SELECT (SELECT count(*) FROM ({V.duck(V.BATCH)}) AS raw) AS fetched,
      count(*) FILTER (WHERE t.id IS NULL) AS to_insert,
      count(*) FILTER (WHERE b.updated > t.updated) AS to_update,
      min(b.event_time) AS min_time, max(b.event_time) AS max_time
    FROM b LEFT JOIN t ON b.id = t.id
    """,
    **SIDES,
)


def merged(batch: str, stored: str) -> str:
    chosen = ", ".join(
        f"CASE WHEN {stored}.id IS NULL OR {batch}.updated > {stored}.updated THEN {batch}.{c} ELSE {stored}.{c} END AS {c}"
        for c in (name.strip() for name in COLUMNS.split(","))
    )
    return f"SELECT {chosen} FROM {batch} FULL OUTER JOIN {stored} ON {batch}.id = {stored}.id"


MERGED = merged("b", "t")
MOVED = SIDES | {"first_two": MERGED, "later": V.duck(V.MOVED), "c": merged("later", "first_two")}
for merge in ("upsert_window", "upsert_by_id", "upsert_bulk", "upsert_twice", "stream_upsert"):
    oracle(merge, MERGED, **SIDES)

MARKS = f"SELECT place, max(event_time) AS latest FROM ({CATALOG}) AS c GROUP BY place"
oracle(
    "ingest_mode",
    f"SELECT place, latest, CASE WHEN {NOW} - latest <= interval '20' hour THEN 'feed' ELSE 'backfill' END AS mode FROM m",
    m=MARKS,
)
oracle(
    "catchup_windows",
    """
    WITH RECURSIVE w AS (
      SELECT place, CAST(0 AS bigint) AS window_no, CAST(latest - interval '1' hour AS timestamp) AS window_start,
        least(latest - interval '1' hour + interval '30' day, timestamp '2024-04-15') AS window_end
      FROM m
      UNION ALL
      SELECT place, window_no + 1, CAST(window_end - interval '1' hour AS timestamp),
        least(window_end - interval '1' hour + interval '30' day, timestamp '2024-04-15')
      FROM w WHERE window_end < timestamp '2024-04-15'
    )
    SELECT place, window_no, window_start, window_end FROM w
    """,
    m=MARKS,
)
oracle("run_status", "SELECT status, status AS derived, count(*) AS runs FROM r GROUP BY status", r=LEDGER)
oracle(
    "integrity",
    "SELECT count(*) AS total_rows, count(DISTINCT id) AS distinct_ids, min(event_time) AS earliest,"
    " max(event_time) AS latest, count(*) = count(DISTINCT id) AS unique_ids FROM b",
    b=V.duck(V.BATCH),
)

# -- range planner: halve a year until it fits ------------------------------

PLAN = """
RECURSIVE times AS (SELECT epoch_us(event_time) AS us FROM h WHERE event_time < timestamp '2001-07-31'),
roots AS (
  SELECT DISTINCT epoch_us(date_trunc('year', event_time)) AS s,
    least(epoch_us(date_trunc('year', event_time) + interval '1' year), epoch_us(timestamp '2001-07-31')) AS e
  FROM h WHERE event_time < timestamp '2001-07-31'
),
tried AS (
  SELECT s, e, (SELECT count(*) FROM times WHERE us >= s AND us < e) AS n FROM roots
  UNION ALL
  SELECT halves.s, halves.e, (SELECT count(*) FROM times WHERE us >= halves.s AND us < halves.e)
  FROM (
    SELECT CASE WHEN k = 0 THEN s ELSE s + (e - s) // 2 END AS s, CASE WHEN k = 0 THEN s + (e - s) // 2 ELSE e END AS e
    FROM tried, (VALUES (0), (1)) AS sides(k) WHERE n > 300
  ) AS halves
),
plan AS (
  SELECT strftime(make_timestamp(s), '%Y%m%dT%H%M%S') || '__' || strftime(make_timestamp(e), '%Y%m%dT%H%M%S')
      || '.parquet' AS chunk,
    make_timestamp(s) AS "start", make_timestamp(e) AS "end", n AS events
  FROM tried WHERE n BETWEEN 1 AND 300
)
"""
oracle("chunk_plan", f"WITH {PLAN.strip()} SELECT * FROM plan", h=HISTORY)
oracle(
    "chunk_reconcile",
    f"""WITH {PLAN.strip()}
    SELECT chunk, "start", "end", events AS expected, rows, events = rows AS complete FROM (
      SELECT *, (SELECT count(*) FROM h WHERE event_time >= "start" AND event_time < "end"
        AND CAST(substring(id, 2) AS bigint) % 500 <> 3) AS rows FROM plan
    ) AS counted
    """,
    h=HISTORY,
)
oracle(
    "resume_pending",
    f'WITH {PLAN.strip()} SELECT * FROM plan WHERE extract(year FROM "start") % 2 = 1',
    h=HISTORY,
)

oracle(
    "resume_backfill",
    f'WITH {PLAN.strip()} SELECT chunk, "start", "end", events AS expected, events AS rows FROM plan',
    h=HISTORY,
)
oracle(
    "resume_grown",
    "SELECT id, event_time, updated, mag, status FROM h WHERE event_time < timestamp '2001-07-31'",
    h=HISTORY,
)
oracle("chunk_reads", "SELECT id, event_time, chunk_start FROM f", f=V.duck(V.CHUNK_FILES))
oracle(
    "range_members",
    """
    SELECT span, count(*) AS events, CAST(sum(CAST(substring(id, 2) AS bigint)) AS bigint) AS numbers
    FROM s JOIN h ON h.event_time BETWEEN s."start" AND s."end" GROUP BY span
    """,
    h=HISTORY,
    s=V.duck(V.SPANS).replace(" AS start", ' AS "start"').replace(" AS end", ' AS "end"'),
)
oracle(
    "range_difference",
    """
    WITH months AS (
      SELECT DISTINCT date_trunc('month', "start") AS month FROM s
    ), held AS (
      SELECT "start", "end" FROM s WHERE span % 100 = 0 AND span % 1000 <> 0
    ), cuts AS (
      SELECT month AS cut FROM months UNION SELECT month + interval '1' month FROM months
      UNION SELECT "start" FROM held UNION SELECT "end" FROM held
    ), parts AS (
      SELECT CAST(cut AS timestamp) AS "start", CAST(lead(cut) OVER (ORDER BY cut) AS timestamp) AS "end" FROM cuts
    )
    SELECT CAST(month AS timestamp) AS month, "start", "end" FROM parts JOIN months ON date_trunc('month', "start") = month
    WHERE "end" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM held WHERE held."start" <= parts."start" AND held."end" >= parts."end")
    """,
    s=V.duck(V.SPANS).replace(" AS start", ' AS "start"').replace(" AS end", ' AS "end"'),
)
DEEP_PLAN = PLAN.replace("2001-07-31", "2024-01-31").replace("n > 300", "n > 8").replace("1 AND 300", "1 AND 8")
oracle(
    "chunk_assign",
    f"""WITH {DEEP_PLAN.strip()}
    SELECT id, event_time, chunk FROM h JOIN plan ON event_time >= "start" AND event_time < "end"
    """,
    h=CATALOG,
)
oracle(
    "silent_windows",
    f"""
    SELECT previous - interval '1' hour AS window_start, started_at AS window_end FROM (
      SELECT started_at, lag(started_at) OVER (ORDER BY started_at) AS previous FROM (
        SELECT started_at FROM r WHERE status <> 'error' UNION SELECT {NOW}
      ) AS good
    ) AS stepped WHERE started_at - previous > interval '30' minute
    """,
    r=LEDGER,
)

# -- catalog analytics -------------------------------------------------------

QUESTIONS = {}
QUESTIONS["arrivals"] = f"""
    SELECT date_trunc('hour', ingested_at) AS ingest_hour, source, count(*) AS events_written,
      {rounded("max(mag)", 1)} AS biggest_mag
    FROM c WHERE ingested_at >= {NOW} - interval '3' day GROUP BY 1, 2
    """
QUESTIONS["freshness"] = f"""
    SELECT max(ingested_at) AS last_write, date_sub('minute', max(ingested_at), {NOW}) AS minutes_since_write,
      max(event_time) AS newest_event, date_sub('minute', max(event_time), {NOW}) AS minutes_behind,
      count(*) AS total_events
    FROM c
    """
oracle(
    "recent_pickup_lag",
    f"""
    SELECT id, event_time, {rounded("mag", 1)} AS mag, place, status, ingested_at,
      date_sub('minute', event_time, ingested_at) AS pickup_lag_minutes
    FROM c WHERE event_time >= {NOW} - interval '2' day ORDER BY event_time DESC, id LIMIT 10
    """,
    c=CATALOG,
)
QUESTIONS["arrivals_pivot"] = f"""
    SELECT date_trunc('hour', ingested_at) AS ingest_hour, count(*) FILTER (WHERE source = 'seed') AS seed,
      count(*) FILTER (WHERE source = 'feed') AS feed, count(*) FILTER (WHERE source = 'backfill') AS backfill
    FROM c WHERE ingested_at >= {NOW} - interval '8' day GROUP BY 1
    """
QUESTIONS["high_water"] = "SELECT max(event_time) AS latest FROM c"
QUESTIONS["source_spans"] = """
    SELECT source, count(*) AS events, min(event_time) AS first_event, max(event_time) AS last_event FROM c GROUP BY source
    """
QUESTIONS["seam_check"] = """
    WITH ends AS (
      SELECT max(event_time) FILTER (WHERE source = 'seed') AS bulk_last,
        min(event_time) FILTER (WHERE source <> 'seed') AS later_first FROM c
    ),
    near AS (
      SELECT c.event_time, c.source, epoch_us(c.event_time) - lag(epoch_us(c.event_time)) OVER (ORDER BY c.event_time) AS step
      FROM c, ends WHERE c.event_time BETWEEN least(bulk_last, later_first) - interval '1' day
        AND greatest(bulk_last, later_first) + interval '1' day
    )
    SELECT bulk_last, later_first, date_sub('minute', bulk_last, later_first) AS seam_minutes,
      (SELECT count(*) FROM near WHERE source = 'seed' AND event_time >= later_first) AS overlap_rows,
      (SELECT max(step) // 1000000 FROM near) AS longest_silence_seconds
    FROM ends
    """

# -- ledger analytics --------------------------------------------------------


def gaps(days: int, on_schedule: int, late: int) -> str:
    return f"""
    SELECT run_id, started_at, status, mode, rows_inserted, rows_updated,
      date_sub('minute', previous, started_at) AS minutes_since_previous_run,
      CASE WHEN previous IS NULL THEN 'first run in window'
        WHEN date_sub('minute', previous, started_at) <= {on_schedule} THEN 'on schedule'
        WHEN date_sub('minute', previous, started_at) <= {late} THEN 'late (GitHub queue delay)'
        ELSE 'GAP -- investigate' END AS verdict,
      error_message
    FROM (SELECT *, lag(started_at) OVER (ORDER BY started_at, run_id) AS previous FROM r
      WHERE started_at >= {NOW} - interval '{days}' day) AS stepped
    """


oracle("run_gaps", gaps(8, 20, 60), r=LEDGER)
oracle("run_gaps_strict", gaps(20, 15, 30), r=LEDGER)
oracle(
    "daily_runs",
    f"""
    SELECT CAST(started_at AS date) AS day, count(*) AS runs, 96 AS runs_expected,
      count(*) FILTER (WHERE status = 'ok') AS runs_with_new_data,
      count(*) FILTER (WHERE status = 'no_new_data') AS runs_quiet,
      count(*) FILTER (WHERE status = 'error') AS runs_failed,
      CAST(sum(rows_inserted) AS bigint) AS events_inserted, CAST(sum(rows_updated) AS bigint) AS events_revised,
      {rounded("avg(duration_ms) / 1000", 1)} AS avg_seconds
    FROM r WHERE started_at >= {NOW} - interval '8' day GROUP BY 1
    """,
    r=LEDGER,
)
oracle(
    "recent_failures",
    "SELECT started_at, mode, error_message, runner_url FROM r WHERE status = 'error'"
    " ORDER BY started_at DESC, run_id LIMIT 50",
    r=LEDGER,
)
oracle(
    "runs_by_trigger",
    f"""
    SELECT trigger, count(*) AS runs, count(*) FILTER (WHERE status = 'error') AS failures,
      min(started_at) AS first_run, max(started_at) AS last_run,
      date_sub('minute', max(started_at), {NOW}) AS minutes_since_last,
      CAST(sum(rows_inserted) AS bigint) AS events_inserted, CAST(sum(rows_updated) AS bigint) AS events_revised
    FROM r WHERE started_at >= {NOW} - interval '8' day GROUP BY trigger
    """,
    r=LEDGER,
)
oracle(
    "revising_runs",
    "SELECT started_at, mode, rows_inserted, rows_updated FROM r WHERE rows_updated > 0"
    " ORDER BY started_at DESC, run_id LIMIT 25",
    r=LEDGER,
)


def hourly(column: str, values: list[str]) -> str:
    columns = ", ".join(f"count(r.run_id) FILTER (WHERE {column} = '{v}') AS \"{v}\"" for v in values)
    return f"""
    SELECT s.hour, {columns}, count(r.run_id) AS total
    FROM (SELECT unnest(generate_series({NOW} - interval '8' day, {NOW}, interval '1' hour)) AS hour) AS s
    LEFT JOIN r ON date_trunc('hour', r.started_at) = s.hour AND r.started_at >= {NOW} - interval '8' day
    GROUP BY s.hour
    """


oracle("runs_by_status_hourly", hourly("status", ["ok", "no_new_data", "error"]), r=LEDGER)
oracle("runs_by_trigger_hourly", hourly("trigger", ["sched-a", "sched-b"]), r=LEDGER)
oracle(
    "delivery_ratio",
    f"""
    SELECT s.day, s.trigger, count(r.run_id) AS runs, 96 AS expected,
      {rounded("count(r.run_id) / CAST(96 AS double)", 3)} AS delivered
    FROM (
      SELECT CAST(d AS date) AS day, t.trigger
      FROM (SELECT unnest(generate_series({NOW} - interval '8' day, {NOW} - interval '1' day, interval '1' day)) AS d) AS days,
        (VALUES ('sched-a'), ('sched-b'), ('sched-c')) AS t(trigger)
    ) AS s
    LEFT JOIN r ON CAST(r.started_at AS date) = s.day AND r.trigger = s.trigger
      AND r.started_at >= {NOW} - interval '8' day
    GROUP BY s.day, s.trigger
    """,
    r=LEDGER,
)


def sessions(by: str) -> str:
    over = "OVER (PARTITION BY trigger ORDER BY started_at)" if by else "OVER (ORDER BY started_at)"
    return f"""
    WITH stepped AS (SELECT *, lag(started_at) {over} AS previous FROM r),
    numbered AS (
      SELECT *, sum(CASE WHEN previous IS NULL OR started_at - previous > interval '20' minute THEN 1 ELSE 0 END)
        {over} AS k FROM stepped
    )
    SELECT {by} min(started_at) AS session_start, max(started_at) AS session_end, count(*) AS runs
    FROM numbered GROUP BY {by} k
    """


oracle("uptime_sessions", sessions(""), r=LEDGER)
for name in ("stream_sessions", "sessions_by_trigger"):
    oracle(name, sessions("trigger,"), r=LEDGER)

# -- integrity ---------------------------------------------------------------

oracle(
    "duplicate_ids",
    "SELECT id, count(*) AS copies FROM f GROUP BY id HAVING count(*) > 1 ORDER BY copies DESC, id LIMIT 20",
    f=V.duck(V.CHUNK_FILES),
)
oracle(
    "duplicate_totals",
    "SELECT count(*) AS total_rows, count(DISTINCT id) AS distinct_ids,"
    " count(*) - count(DISTINCT id) AS duplicates FROM f",
    f=V.duck(V.CHUNK_FILES),
)
oracle(
    "revision_lag",
    f"""
    SELECT status, count(*) AS events,
      {rounded("avg(date_sub('hour', event_time, updated))", 1)} AS avg_hours_to_last_revision,
      max(date_sub('day', event_time, updated)) AS max_days_to_last_revision
    FROM c WHERE updated IS NOT NULL GROUP BY status
    """,
    c=CATALOG,
)

# -- history -----------------------------------------------------------------

DAY = f"CAST({HISTORY_NOW} AS date)"
oracle(
    "today_vs_history",
    f"""
    WITH today AS (
      SELECT count(*) AS n, count(*) FILTER (WHERE mag >= 4.5) AS big, max(mag) AS biggest
      FROM h WHERE CAST(event_time AS date) = {DAY}
    ),
    past AS (
      SELECT count(*) / nullif(CAST(count(DISTINCT extract(year FROM event_time)) AS double), 0) AS usual,
        count(*) FILTER (WHERE mag >= 4.5) / nullif(CAST(count(DISTINCT extract(year FROM event_time)) AS double), 0) AS big,
        max(mag) AS biggest, count(DISTINCT extract(year FROM event_time)) AS years
      FROM h WHERE extract(doy FROM event_time) = extract(doy FROM {DAY}) AND CAST(event_time AS date) < {DAY}
    )
    SELECT today.n AS events_today, {rounded("past.usual", 1)} AS avg_events_this_day_of_year,
      {rounded("today.n / nullif(past.usual, 0)", 2)} AS ratio_vs_normal, today.big AS m45_plus_today,
      {rounded("past.big", 2)} AS avg_m45_plus, {rounded("today.biggest", 1)} AS biggest_today,
      {rounded("past.biggest", 1)} AS biggest_ever_this_day, past.years AS years_of_history
    FROM today, past
    """,
    h=HISTORY,
)
oracle(
    "magnitude_bands",
    f"""
    SELECT CAST(extract(year FROM event_time) AS int) AS year, count(*) FILTER (WHERE mag < 2) AS under_m2,
      count(*) FILTER (WHERE mag >= 2 AND mag < 4) AS m2_to_m4, count(*) FILTER (WHERE mag >= 4 AND mag < 5) AS m4_to_m5,
      count(*) FILTER (WHERE mag >= 5 AND mag < 6) AS m5_to_m6, count(*) FILTER (WHERE mag >= 6) AS m6_plus,
      count(*) AS total
    FROM h WHERE event_time < date_trunc('year', {HISTORY_NOW}) GROUP BY 1
    """,
    h=HISTORY,
)


def hourly_against(days: int, hours: str) -> str:
    return f"""
    WITH recent AS (
      SELECT date_trunc('hour', event_time) AS hour, count(*) AS n FROM h
      WHERE event_time >= {HISTORY_NOW} - interval '24' hour GROUP BY 1
    ),
    usual AS (
      SELECT count(*) / CAST({hours} AS double) AS u FROM h
      WHERE event_time >= {HISTORY_NOW} - interval '{days}' day AND event_time < {HISTORY_NOW} - interval '24' hour
    )
    SELECT hour, n AS events_this_hour, {rounded("u", 1)} AS ten_year_hourly_average,
      {rounded("n / u", 2)} AS ratio
    FROM recent, usual
    """


oracle("hourly_vs_baseline", hourly_against(3650, "count(DISTINCT date_trunc('hour', event_time))"), h=HISTORY)
oracle("hourly_vs_dense_baseline", hourly_against(2000, "47976"), h=HISTORY)
for asked in ("today_vs_history", "hourly_vs_baseline"):
    ORACLES[f"{asked}_table"] = ORACLES[asked]
oracle(
    "pickup_lag_table",
    f"""
    SELECT id, event_time, {rounded("mag", 1)} AS mag, CAST(NULL AS varchar) AS place, status, ingested_at,
      date_sub('minute', event_time, ingested_at) AS pickup_lag_minutes
    FROM h WHERE event_time >= {HISTORY_NOW} - interval '30' day ORDER BY event_time DESC, id LIMIT 10
    """,
    h=HISTORY,
)

QUESTIONS["health_verdict"] = f"""
    SELECT *, CASE WHEN stale THEN 'STALE' ELSE 'healthy' END
      || CASE WHEN runs_low THEN ' / RUNS BELOW EXPECTED' ELSE '' END AS verdict
    FROM (
      SELECT *, age_minutes IS NULL OR age_minutes > 90 AS stale, total_runs < 60 AS runs_low FROM (
        SELECT max(ingested_at) AS last_write, date_sub('minute', max(ingested_at), {NOW}) AS age_minutes,
          count(*) AS total_events FROM c
      ) AS fresh, (
        SELECT count(*) FILTER (WHERE status = 'ok') AS ok_runs,
          count(*) FILTER (WHERE status = 'no_new_data') AS quiet_runs,
          count(*) FILTER (WHERE status = 'error') AS failed_runs, count(*) AS total_runs
        FROM r WHERE started_at >= {NOW} - interval '24' hour
      ) AS recent
    ) AS judged
    """
# Asked of a DataFrame, and of a stored table after three deliveries.
for question, text in QUESTIONS.items():
    oracle("arrivals_per_hour" if question == "arrivals" else question, text, c=CATALOG, r=LEDGER)
    oracle(f"{question}_table", text, **MOVED, r=LEDGER)

# -- streams -----------------------------------------------------------------

oracle(
    "stream_arrivals",
    "SELECT date_trunc('hour', ingested_at) AS ingest_hour, source, count(*) AS events_written FROM c GROUP BY 1, 2",
    c=CATALOG,
)
oracle(
    "stream_late",
    """
    SELECT date_trunc('hour', ingested_at) AS ingest_hour, source, count(*) AS events_written FROM c
    WHERE date_trunc('hour', ingested_at) + interval '1' hour
      <= (SELECT date_trunc('millisecond', max(ingested_at)) - interval '24' hour FROM c)
    GROUP BY 1, 2
    """,
    c=CATALOG,
)
oracle(
    "stream_dedupe",
    "SELECT id, updated, status FROM c UNION ALL SELECT id, updated, 'other' AS status FROM c WHERE sig % 10 = 3",
    c=CATALOG,
)
oracle(
    "stream_ledger",
    "SELECT 'stream' AS trigger, 'ok' AS status, CAST(2 AS bigint) AS runs, count(*) AS fetched,"
    " count(*) AS inserted, CAST(0 AS bigint) AS updated FROM c",
    c=CATALOG,
)
oracle(
    "stream_sliding",
    """
    SELECT window_start, window_start + interval '24' hour AS window_end, count(*) AS events FROM (
      SELECT unnest(generate_series(date_trunc('hour', event_time) - interval '23' hour,
        date_trunc('hour', event_time), interval '1' hour)) AS window_start FROM c
    ) AS opened GROUP BY 1
    """,
    c=CATALOG,
)
