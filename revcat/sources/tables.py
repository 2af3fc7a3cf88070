"""Parquet and JSON-lines tables with the schema pinned, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revcat.functions.times import instant, month_key
from revcat.schema import EVENTS, as_nullable, conform, enforce_required

BROADCAST_FILES = 50_000  # longest list of file names and bins sent to every executor

_JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"  # the default keeps milliseconds only


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType = EVENTS) -> DataFrame:
    """All files below ``path`` in one parallel scan."""
    paths = [path] if isinstance(path, str) else path
    return conform(spark.read.schema(as_nullable(schema)).parquet(*paths), schema)


def write_parquet(df: DataFrame, path: str, schema: T.StructType = EVENTS, mode: str = "errorifexists") -> None:
    conform(df, schema).write.mode(mode).option("compression", "zstd").parquet(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType = EVENTS, on_bad: str = "fail"
) -> DataFrame:
    """Newline JSON. ``on_bad="fail"`` fails on malformed lines and missing required values.

    ``on_bad="null"`` reads what fits and leaves the rest NULL, for a later split.
    """
    mode = {"fail": "FAILFAST", "null": "PERMISSIVE"}[on_bad]
    rows = spark.read.schema(as_nullable(schema)).json(path, mode=mode, timestampFormat=_JSON_TIME)
    return enforce_required(rows, schema) if on_bad == "fail" else rows


def write_json_lines(df: DataFrame, path: str, schema: T.StructType = EVENTS, mode: str = "errorifexists") -> None:
    conform(df, schema).write.mode(mode).json(path, ignoreNullFields=True, timestampFormat=_JSON_TIME)


def write_months(df: DataFrame, path: str, schema: T.StructType = EVENTS, mode: str = "errorifexists") -> None:
    """Month-partitioned Parquet, ids ordered inside each file.

    The rebalance hint lets the runtime split a month that is far larger than
    the rest over several tasks and join small ones.
    """
    (
        conform(df, schema)
        .withColumn("event_month", month_key(F.col("event_time")))
        .hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", "id")
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy("event_month")
        .parquet(path)
    )


def read_months(
    spark: SparkSession, path: str, start=None, end=None, schema: T.StructType = EVENTS
) -> DataFrame:
    """Events in [start, end). Time bounds alone prune no directories, so the month bound is added."""
    layout = T.StructType([*as_nullable(schema), T.StructField("event_month", T.StringType())])
    rows = spark.read.schema(layout).parquet(path)
    for bound, compare in ((start, "__ge__"), (end, "__lt__")):
        if bound is not None:
            at = instant(bound)
            rows = rows.where(getattr(F.col("event_time"), compare)(at))
            inside = "__ge__" if compare == "__ge__" else "__le__"
            rows = rows.where(getattr(F.col("event_month"), inside)(month_key(at)))
    return rows.select(*[f.name for f in schema])


def compaction_bins(sources: DataFrame, name: str, rows: str, rows_per_file: int) -> DataFrame:
    """(name, rows, bin): sources by name, each bin closed by the source that fills it.

    Where a bin begins depends on where the last one ended, so this is a walk over
    the list of sources on the driver, which holds one entry per file, as its file
    listing does. A bin has less than ``rows_per_file`` rows besides its last source.
    """
    placed, number, filled = [], 0, 0
    for source, n in sources.select(name, F.col(rows).cast("bigint")).orderBy(name).collect():
        placed.append((source, n, number))
        filled += n
        if filled >= rows_per_file:
            number, filled = number + 1, 0
    layout = T.StructType(
        [sources.schema[name], T.StructField(rows, T.LongType()), T.StructField("bin", T.LongType())]
    )
    return sources.sparkSession.createDataFrame(placed, layout)


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    rows_per_file: int = 500_000,
    schema: T.StructType = EVENTS,
) -> int:
    """Join many small files, in the order of their names, into few; fails unless no row is lost.

    One folder ``bin=`` per bin of ``compaction_bins``. Only whole files move together,
    so nothing is ordered across bins; a bin far larger than the rest is written by several tasks.
    """
    stored = spark.read.schema(as_nullable(schema)).parquet(source)
    rows = stored.select(*schema.names, F.col("_metadata.file_path").alias("_file"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))  # from the footers
    bins = compaction_bins(sizes, "_file", "_rows", rows_per_file)
    files, total = bins.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    bins = bins.drop("_rows")
    (
        rows.join(F.broadcast(bins) if files <= BROADCAST_FILES else bins, "_file")
        .drop("_file")
        .hint("rebalance", "bin")
        .sortWithinPartitions("bin", "event_time", "id")
        .write.partitionBy("bin")
        .option("compression", "zstd")
        .parquet(target)
    )
    written = read_parquet(spark, target, schema).count()
    if written != total:
        raise RuntimeError(f"compaction wrote {written} of {total} rows")
    return written
