"""Landing history in size-bounded chunks, resumable from a manifest that is checked against the data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revcat.functions.times import chunk_key, instant
from revcat.operators.ranges import MAX_EVENTS_PER_CHUNK, in_ranges, plan_chunks, range_counts, uncovered
from revcat.schema import EVENTS, as_nullable, conform
from revcat.session import written
from revcat.sources import files
from revcat.sources.ledger import utc_now

MANIFEST = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("expected", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("superseded", T.BooleanType()),
    ]
)
CHUNK = ["run", "chunk"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Landed chunks that still count; a chunk is taken back by listing it again as superseded."""
    if not files.child_names(spark, path):
        return spark.createDataFrame([], MANIFEST).drop("superseded")
    entries = spark.read.schema(MANIFEST).parquet(path)
    latest = entries.groupBy(*CHUNK).agg(F.max_by(F.struct(*MANIFEST.names), "superseded").alias("entry"))
    return latest.select("entry.*").where("not superseded").drop("superseded")


def read_landed(spark: SparkSession, out: str, manifest: str) -> DataFrame:
    """Events of the landed chunks that still count, each chunk once, with ``run`` and ``chunk``."""
    listed = read_manifest(spark, manifest).select(*CHUNK)
    return _landed(spark, out, written(listed, "listed")).join(listed, CHUNK, "left_semi")


def _landed(spark: SparkSession, out: str, listed: DataFrame) -> DataFrame:
    """All rows in the folders of the listed runs, as far as the folders are there."""
    # One name per run that landed anything.
    runs = {r.run for r in listed.select("run").distinct().collect()}
    folders = [f"{out}/{name}" for name in files.child_names(spark, out) if name.removeprefix("run=") in runs]
    layout = T.StructType([*as_nullable(EVENTS), T.StructField("chunk", T.StringType()), T.StructField("run", T.StringType())])
    if not folders:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).option("basePath", out).parquet(*folders)


def _still_right(rows: DataFrame, out: str, listed: DataFrame) -> DataFrame:
    """Listed chunks with ``right``: all their rows are there, and the archive holds no more and no less."""
    spark = rows.sparkSession
    there = _landed(spark, out, listed).groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("there"))
    named = listed.withColumn("named", F.concat_ws("/", *CHUNK))
    now = range_counts(rows, named, "named").select("named", F.col("events").alias("now"))
    judged = named.join(there, CHUNK, "left").join(now, "named", "left").drop("named")
    right = (F.coalesce("there", F.lit(0)) == F.col("rows")) & (F.coalesce("now", F.lit(0)) == F.col("rows"))
    return judged.withColumn("right", right).drop("there", "now")


def land_history(
    archive: DataFrame,
    out: str,
    manifest: str,
    end,
    cap: int = MAX_EVENTS_PER_CHUNK,
    years: list[int] | None = None,
    start=None,
) -> DataFrame:
    """Copy ``archive`` events of [start, end) to ``out`` chunk by chunk; returns the manifest.

    What the manifest lists is checked first: a chunk whose rows are gone, or
    whose range holds another number of events in the archive by now, is marked
    superseded. What the remaining ones do not cover of today's plan is landed, cut where
    a new chunk reaches into an old one, in one job for all years and one folder
    ``run=``. Chunks are listed after their rows are written, so an interrupted run leaves
    an unlisted folder, which ``read_landed`` does not read. A revision that
    changes no count stays unnoticed: history is landed for events, the feed brings revisions.
    """
    spark = archive.sparkSession
    rows = conform(archive, EVENTS).where(F.col("event_time") < instant(end))
    if start is not None:
        rows = rows.where(F.col("event_time") >= instant(start))
    listed = written(_still_right(rows, out, written(read_manifest(spark, manifest), "listed")), "checked")
    gone = listed.where("not right").withColumns({"landed_at": instant(utc_now()), "superseded": F.lit(True)})
    if not gone.isEmpty():
        gone.select(*MANIFEST.names).write.mode("append").parquet(manifest)
    plan = plan_chunks(rows, end, cap).chunks
    todo = uncovered(plan, listed.where("right"), "chunk")
    if years is not None:
        todo = todo.where(F.year("start").isin(years))
    todo = todo.select(chunk_key(F.col("start"), F.col("end")).alias("chunk"), "start", "end")
    todo = range_counts(rows, written(todo, "todo"), "chunk").withColumnRenamed("events", "expected")
    todo = written(todo.where("expected > 0"), "todo")
    if not todo.isEmpty():
        run = uuid.uuid4().hex
        folder = f"{out}/run={run}"
        (
            in_ranges(rows, todo, "chunk", closed=False)
            .hint("rebalance", "chunk")
            .sortWithinPartitions("chunk", "event_time")
            .write.option("compression", "zstd")
            .parquet(folder)
        )
        layout = T.StructType([*as_nullable(EVENTS), T.StructField("chunk", T.StringType())])
        counts = spark.read.schema(layout).parquet(folder).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
        (
            todo.join(counts, "chunk", "left")
            .withColumns({
                "run": F.lit(run), "rows": F.coalesce("rows", F.lit(0).cast("bigint")),
                "landed_at": instant(utc_now()), "superseded": F.lit(False),
            })
            .select(*MANIFEST.names)
            .write.mode("append")
            .parquet(manifest)
        )
    return read_manifest(spark, manifest)
