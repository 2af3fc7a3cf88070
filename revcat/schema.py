"""The two table schemas, defined once, and conformance to them by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TS, _STR, _DBL, _INT = T.TimestampType(), T.StringType(), T.DoubleType(), T.LongType()

# Column names, order, types and nullability of the two tables.
EVENTS = T.StructType(
    [
        T.StructField("id", _STR, False),
        T.StructField("event_time", _TS, False),
        T.StructField("updated", _TS),
        T.StructField("mag", _DBL),
        T.StructField("mag_type", _STR),
        T.StructField("place", _STR),
        T.StructField("latitude", _DBL),
        T.StructField("longitude", _DBL),
        T.StructField("depth_km", _DBL),
        T.StructField("status", _STR),
        T.StructField("event_type", _STR),
        T.StructField("net", _STR),
        T.StructField("tsunami", T.BooleanType()),
        T.StructField("sig", _INT),
        T.StructField("felt", _INT),
        T.StructField("cdi", _DBL),
        T.StructField("mmi", _DBL),
        T.StructField("alert", _STR),
        T.StructField("nst", _INT),
        T.StructField("dmin", _DBL),
        T.StructField("rms", _DBL),
        T.StructField("gap", _DBL),
        T.StructField("url", _STR),
        T.StructField("source", _STR),
        T.StructField("ingested_at", _TS, False),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", _STR, False),
        T.StructField("started_at", _TS, False),
        T.StructField("finished_at", _TS),
        T.StructField("duration_ms", _INT),
        T.StructField("trigger", _STR),
        T.StructField("mode", _STR),
        T.StructField("window_start", _TS),
        T.StructField("window_end", _TS),
        T.StructField("rows_fetched", _INT),
        T.StructField("rows_inserted", _INT),
        T.StructField("rows_updated", _INT),
        T.StructField("status", _STR, False),
        T.StructField("error_message", _STR),
        T.StructField("runner_url", _STR),
    ]
)


def as_nullable(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable: what a file reader can promise."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def conform(df: DataFrame, schema: T.StructType = EVENTS) -> DataFrame:
    """Columns of ``schema`` in its order, matched by name; missing ones become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def missing_required(schema: T.StructType = EVENTS):
    """True for a row that lacks a required value."""
    lacking = F.lit(False)
    for name in required(schema):
        lacking = lacking | F.col(name).isNull()
    return lacking


def enforce_required(df: DataFrame, schema: T.StructType = EVENTS) -> DataFrame:
    """Fail the job, while it runs, on the first row that lacks a required value."""
    checked = {
        name: F.when(
            F.col(name).isNull(), F.raise_error(F.lit(f"required column {name} is NULL"))
        ).otherwise(F.col(name))
        for name in required(schema)
    }
    return df.withColumns(checked)


def split_required(df: DataFrame, schema: T.StructType = EVENTS) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows to quarantine)."""
    lacking = missing_required(schema)
    return df.where(~lacking), df.where(lacking)


def null_report(df: DataFrame, schema: T.StructType = EVENTS) -> DataFrame:
    """One row per required column: total rows and rows where it is NULL."""
    names = required(schema)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(n).isNull()).alias(n) for n in names],
    )
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr("total", f"stack({len(names)}, {pairs}) as (column_name, null_rows)").select(
        "column_name", F.col("total").alias("total_rows"), "null_rows"
    )
