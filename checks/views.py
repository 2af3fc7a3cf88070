"""Test inputs derived from the driver's tables.

The texts run unchanged in Spark and in DuckDB; ``{events}`` and ``{orders}``
stand for the tables. All arithmetic is on keys, so it works at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG_AS_OF = "2024-01-31 00:00:00"
HISTORY_AS_OF = "2001-07-31 12:00:00"

# An explicit TIMESTAMP: the files carry no zone and would read as TIMESTAMP_NTZ.
TABLES = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
}

CATALOG = """
SELECT
  concat('ev', CAST(event_id AS string)) AS id,
  CAST(ts AS timestamp) AS event_time,
  CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS timestamp) + (event_id % 72) * interval '1' hour END AS updated,
  CASE WHEN event_id % 97 <> 0 THEN value / 70 END AS mag,
  CASE WHEN event_id % 4 = 0 THEN 'ml' ELSE 'mb' END AS mag_type,
  concat('user ', CAST(user_id AS string)) AS place,
  CAST(event_id * 37 % 18000 AS double) / 100 - 90 AS latitude,
  CAST(event_id * 91 % 36000 AS double) / 100 - 180 AS longitude,
  CAST(event_id % 700 AS double) AS depth_km,
  CASE WHEN event_id % 3 = 0 THEN 'automatic' ELSE 'reviewed' END AS status,
  event_type,
  concat('n', CAST(user_id % 7 AS string)) AS net,
  event_id % 211 = 0 AS tsunami,
  event_id % 1000 AS sig,
  CASE WHEN event_id % 5 = 0 THEN event_id % 40 END AS felt,
  CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 9 AS double) END AS cdi,
  CASE WHEN event_id % 11 = 0 THEN CAST(event_id % 8 AS double) END AS mmi,
  CASE WHEN event_id % 50 = 0 THEN 'green' END AS alert,
  event_id % 60 AS nst,
  CAST(event_id % 13 AS double) / 10 AS dmin,
  CAST(event_id % 19 AS double) / 10 AS rms,
  CAST(event_id % 360 AS double) AS gap,
  concat('https://events.example/', CAST(event_id AS string)) AS url,
  CASE WHEN ts < timestamp '2024-01-24 00:00:00' THEN 'seed'
       WHEN event_id % 50 = 0 THEN 'backfill' ELSE 'feed' END AS source,
  CASE WHEN ts < timestamp '2024-01-24 00:00:00' THEN timestamp '2024-01-24 00:05:00'
       ELSE CAST(ts AS timestamp) + (event_id % 45) * interval '1' minute END AS ingested_at,
  event_id
FROM {events}
"""

HISTORY = """
SELECT
  concat('h', CAST(o_orderkey AS string)) AS id,
  CAST(o_orderdate AS timestamp) + (o_orderkey * 7919 % 86400) * interval '1' second AS event_time,
  CAST(o_orderdate AS timestamp) + (o_orderkey * 7919 % 86400) * interval '1' second AS updated,
  o_totalprice / 65000 AS mag,
  o_orderstatus AS status,
  'seed' AS source,
  timestamp '2001-08-02 00:00:00' AS ingested_at,
  o_custkey
FROM {orders}
"""

LEDGER = """
SELECT
  concat('run-', CAST(k AS string)) AS run_id,
  slot AS started_at,
  slot + n * interval '1' second AS finished_at,
  n * 1000 AS duration_ms,
  CASE WHEN k % 3 = 0 THEN 'sched-b' ELSE 'sched-a' END AS trigger,
  CASE WHEN k % 20 = 0 THEN 'backfill' ELSE 'feed' END AS mode,
  CASE WHEN k % 20 = 0 THEN slot - interval '1' hour END AS window_start,
  CASE WHEN k % 20 = 0 THEN slot END AS window_end,
  n AS rows_fetched,
  CASE WHEN e >= 2 THEN CAST(0 AS bigint) ELSE ins END AS rows_inserted,
  CASE WHEN e >= 2 THEN CAST(0 AS bigint) ELSE upd END AS rows_updated,
  CASE WHEN e >= 2 THEN 'error' WHEN ins + upd > 0 THEN 'ok' ELSE 'no_new_data' END AS status,
  CASE WHEN e >= 2 THEN concat('E', CAST(e AS string)) END AS error_message,
  concat('https://runs.example/', CAST(k AS string)) AS runner_url
FROM (
  SELECT
    slot,
    count(*) AS n,
    count(CASE WHEN event_type = 'error' THEN 1 END) AS e,
    count(CASE WHEN event_type = 'click' THEN 1 END) AS ins,
    count(CASE WHEN event_type = 'view' THEN 1 END) AS upd,
    min(event_id) AS k
  FROM (
    SELECT
      date_trunc('hour', CAST(ts AS timestamp))
        + CAST(floor(extract(minute FROM ts) / 15) AS int) * interval '15' minute AS slot,
      event_type, event_id
    FROM {events}
  ) AS slots
  GROUP BY slot
) AS per_slot
"""

# Many revisions per id.
REVISIONS = """
SELECT
  user_id AS id,
  CAST(ts AS timestamp) AS updated,
  CAST(ts AS timestamp) + (event_id % 45) * interval '1' minute AS ingested_at,
  event_id AS position,
  value / 70 AS mag
FROM {events}
"""

# The same with many equal revisions, some of them NULL.
TIED_REVISIONS = """
SELECT
  user_id AS id,
  CASE WHEN event_id % 5 <> 0 THEN date_trunc('day', CAST(ts AS timestamp)) END AS updated,
  event_id AS position,
  value / 70 AS mag
FROM {events}
"""

EVENT_COLUMNS = (
    "id, event_time, updated, mag, mag_type, place, latitude, longitude, depth_km, status, event_type, net,"
    " tsunami, sig, felt, cdi, mmi, alert, nst, dmin, rms, gap, url, source, ingested_at"
)

TARGET = f"SELECT {EVENT_COLUMNS} FROM ({CATALOG}) AS c WHERE event_id % 5 <> 0"

_SAME = EVENT_COLUMNS.replace("id, event_time, updated, mag, ", "").replace("source, ingested_at", "")

# Ranges of very unequal length: an instant, an hour, ten days, a year.
SPANS = """
SELECT o_orderkey AS span, event_time AS start, event_time
  + CASE WHEN o_orderkey % 1000 = 0 THEN interval '365' day WHEN o_orderkey % 100 = 0 THEN interval '10' day
      WHEN o_orderkey % 3 = 0 THEN interval '1' hour ELSE interval '0' hour END AS end
FROM (
  SELECT o_orderkey, CAST(o_orderdate AS timestamp) + (o_orderkey * 7919 % 86400) * interval '1' second AS event_time
  FROM {orders}
) AS o
"""

# Later delivery of the second half of the month: newer, equal, older, NULL and
# moved revisions, and a stale copy of every seventh row.
_CHANGED = f"""
SELECT
  id,
  CASE WHEN event_id % 40 = 8 THEN event_time + interval '20' day ELSE event_time END AS event_time,
  CASE WHEN event_id % 34 = 0 THEN event_time + interval '5' hour
       WHEN event_id % 46 = 2 THEN NULL
       WHEN event_id % 2 = 0 THEN updated + interval '1' hour
       ELSE updated END AS updated,
  mag * 2 AS mag,
  {_SAME}
  'feed' AS source,
  timestamp '2024-01-31 00:00:00' AS ingested_at,
  event_id
FROM ({CATALOG}) AS c
WHERE event_time >= timestamp '2024-01-15 00:00:00'
"""

BATCH = f"""
SELECT {EVENT_COLUMNS}, 1 AS position, event_id FROM ({_CHANGED}) AS fresh
UNION ALL
SELECT id, event_time, updated - interval '1' hour AS updated, mag + 1 AS mag, {_SAME}
  source, ingested_at, 0 AS position, event_id
FROM ({_CHANGED}) AS stale WHERE event_id % 7 = 0
"""

# A still later delivery that moves events to other hours of arrival, another source and
# earlier times, the newest of them too.
MOVED = f"""
SELECT id, event_time - interval '10' day AS event_time, event_time + interval '60' day AS updated,
  mag / 2 AS mag, {_SAME}
  'backfill' AS source, timestamp '2024-01-30 06:00:00' - (event_id % 50) * interval '1' hour AS ingested_at, event_id
FROM ({CATALOG}) AS c
WHERE event_time >= timestamp '2024-01-15 00:00:00' AND event_id % 3 <> 0
"""

# History cut in monthly files whose ranges include both ends, so an order on
# the first instant of a month is in two files.
CHUNK_FILES = """
SELECT concat('c', CAST(o_orderkey AS string)) AS id, CAST(o_orderdate AS timestamp) AS event_time,
  CAST(o_orderdate AS timestamp) AS updated, o_totalprice / 65000 AS mag, 'seed' AS source,
  timestamp '2001-08-02 00:00:00' + (o_orderkey % 3) * interval '1' second AS ingested_at,
  date_trunc('month', CAST(o_orderdate AS timestamp)) AS chunk_start
FROM {orders}
UNION ALL
SELECT concat('c', CAST(o_orderkey AS string)) AS id, CAST(o_orderdate AS timestamp) AS event_time,
  CAST(o_orderdate AS timestamp) AS updated, o_totalprice / 65000 AS mag, 'seed' AS source,
  timestamp '2001-08-02 00:01:00' + (o_orderkey % 3) * interval '1' second AS ingested_at,
  CAST(date_trunc('month', CAST(o_orderdate AS timestamp)) - interval '1' month AS timestamp) AS chunk_start
FROM {orders}
WHERE CAST(o_orderdate AS timestamp) = date_trunc('month', CAST(o_orderdate AS timestamp))
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    tables = {n: table(spark, sf_dir, n) for n in TABLES if "{" + n + "}" in text}
    return spark.sql(text, **tables)


def duck(text: str) -> str:
    """The view's text over the driver's tables."""
    return text.format(**{n: n for n in TABLES})
