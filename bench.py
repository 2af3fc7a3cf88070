"""Headline queries, timed warm; prints one JSON line.

    python bench.py            # every headline query, median of three
    python bench.py --stored   # one bulk upsert, and questions to the table it makes
    python bench.py --bulk     # 4.8M-row upsert onto 681 months, and trickle upserts onto it

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) set the scale.
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from checks.queries import QUERIES
from revcat.operators.revisions import latest_revision, latest_revision_state
from revcat.plans import liveness
from revcat.session import scratch_dir, session, written
from revcat.sources.catalog import CatalogTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = [
    "arrivals_per_hour", "freshness", "recent_pickup_lag", "run_gaps", "daily_runs", "runs_by_trigger",
    "duplicate_ids", "duplicate_totals", "revision_lag", "today_vs_history", "magnitude_bands",
    "hourly_vs_baseline", "health_verdict", "latest_revision", "latest_revision_window", "merge_probe",
    "normalize", "chunk_plan", "range_counts", "seam_check", "uptime_sessions", "range_scan",
    "upsert_window", "upsert_bulk", "upsert_twice", "stream_upsert", "stream_arrivals",
]

# Every line item eight times, spread over the months from 1970 to 2026.
BULK = """
SELECT concat('b', l_orderkey, '-', l_linenumber, '-', l_suppkey, '-', copy) AS id,
  timestamp '1970-01-01' + ((l_orderkey * 7919 + l_linenumber * 104729 + copy * 1299709) % 20700) * interval '1' day
    + (l_partkey % 86400) * interval '1' second AS event_time,
  timestamp '2026-01-01' + (l_partkey % 1000) * interval '1' hour AS updated,
  l_quantity / 10 AS mag, 'ml' AS mag_type, concat('place ', l_suppkey) AS place,
  l_extendedprice % 90 AS latitude, l_extendedprice % 180 AS longitude, l_quantity AS depth_km,
  'reviewed' AS status, 'earthquake' AS event_type, 'n1' AS net, false AS tsunami, l_partkey AS sig,
  l_suppkey AS felt, l_quantity AS gap, concat('https://events.example/', l_orderkey) AS url,
  'seed' AS source, timestamp '2026-09-10' AS ingested_at
FROM {lineitem} LATERAL VIEW explode(sequence(0, 7)) AS copy
"""


def run_whole(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    begun = time.perf_counter()
    action()
    return time.perf_counter() - begun


def headline(spark: SparkSession) -> dict[str, float]:
    def once(name: str) -> float:
        return timed(lambda: run_whole(QUERIES[name](spark, SF_DIR)))

    seconds = {}
    for name in HEADLINE:
        once(name)  # warm
        seconds[name] = round(statistics.median(once(name) for _ in range(3)), 3)
    return seconds


def stored(spark: SparkSession) -> dict[str, float]:
    """The bulk upsert of 4.8M rows (at sf0.1), and questions to the table it makes, without making it."""
    rows = written(V.view(spark, SF_DIR, BULK).repartition(64), "bulk")
    CatalogTable(spark, scratch_dir(spark, "warm")).create().upsert(rows.where("sig % 20 = 0"), bulk=True)
    table = CatalogTable(spark, scratch_dir(spark, "catalog")).create()
    now = "2026-09-11"
    seconds = {"bulk_upsert": round(timed(lambda: table.upsert(rows, bulk=True)), 3)}
    questions = {
        "table_arrivals_per_hour": lambda: run_whole(liveness.arrivals_per_hour(table, now)),
        "table_freshness": lambda: run_whole(liveness.freshness(table, now)),
        "table_scan_one_day": lambda: run_whole(table.scan("2026-01-01", "2026-01-02")),
    }
    for name, ask in questions.items():
        ask()  # warm
        seconds[name] = round(statistics.median(timed(ask) for _ in range(3)), 3)
    return seconds


def bulk(spark: SparkSession) -> dict[str, float]:
    rows = written(V.view(spark, SF_DIR, BULK).repartition(64), "bulk")
    table = CatalogTable(spark, scratch_dir(spark, "catalog")).create()
    warm = CatalogTable(spark, scratch_dir(spark, "warm")).create()
    warm.upsert(rows, bulk=True)
    newer = rows.where("pmod(hash(id), 3) = 0").withColumn("updated", F.col("updated") + F.expr("interval 1 day"))
    recent = written(rows.where("event_time >= timestamp'2026-08-25'").orderBy("id").limit(300), "recent")

    def revised(days: int) -> DataFrame:
        return recent.withColumn("updated", F.col("updated") + F.expr(f"interval {days} days"))

    moved = revised(7).limit(1).withColumn("event_time", F.expr("timestamp'1980-06-15'"))
    steps = {
        "newest_revision_by_rank": lambda: run_whole(latest_revision(rows, then=["ingested_at"])),
        "newest_revision_by_aggregate": lambda: run_whole(latest_revision_state(rows, then=["ingested_at"])),
        "bulk_upsert_empty_table": lambda: table.upsert(rows, bulk=True),
        "bulk_replay": lambda: table.upsert(rows, bulk=True),
        "bulk_upsert_third_newer": lambda: table.upsert(newer, bulk=True),
        "trickle_300_near": lambda: table.upsert(revised(5), within="1 day"),
        "trickle_300_by_id": lambda: table.upsert(revised(6)),
        "trickle_replay_by_id": lambda: table.upsert(revised(6)),
        "trickle_one_moved_46_years": lambda: table.upsert(moved),
        "scan_one_day": lambda: run_whole(table.scan("2026-01-01", "2026-01-02")),
        "scan_everything": lambda: run_whole(table.scan()),
    }
    seconds = {name: round(timed(step), 3) for name, step in steps.items()}
    seconds["rows"] = rows.count()
    return seconds


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--bulk", action="store_true")
    parser.add_argument("--stored", action="store_true")
    arguments = parser.parse_args()
    spark = session(
        "bench",
        spark_master=f"local[{CPUS}]",
        spark_sql_shuffle_partitions=CPUS,
        spark_driver_memory="12g",
        spark_ui_enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = bulk(spark) if arguments.bulk else stored(spark) if arguments.stored else headline(spark)
    total = round(sum(v for k, v in seconds.items() if k != "rows"), 3)
    metric = "bulk_upsert_seconds" if arguments.bulk else "headline_queries_total_seconds"
    print(json.dumps({"metric": metric, "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR)}))


if __name__ == "__main__":
    main()
