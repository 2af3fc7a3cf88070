"""Newest revision per id, and what a batch would do to a stored catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_revision(
    df: DataFrame, key: str = "id", version: str = "updated", then: Sequence[str] = ()
) -> DataFrame:
    """Per key the row with the greatest (version, *then); NULL is the oldest version."""
    order = [F.col(name).desc_nulls_last() for name in (version, *then)]
    return latest_revision_window(df, order, key)


def latest_revision_window(df: DataFrame, order: Sequence[Column], key: str = "id") -> DataFrame:
    """Per key the first row in ``order``, by ROW_NUMBER.

    Spark applies the rank filter below the shuffle too (WindowGroupLimit): a
    map task sends one row per key, so a key with very many revisions never
    gathers in one task. Rows equal in ``order`` are told apart by a hash of
    the whole row, which keeps the choice the same when a task is run again.
    """
    total = [*order, F.xxhash64(*df.columns)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*total)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_revision_state(
    df: DataFrame, key: str = "id", version: str = "updated", then: Sequence[str] = ()
) -> DataFrame:
    """The same choice as an arg-max aggregate, the form a stream can keep as state.

    In batch it takes about twice as long on wide rows: the struct it keeps
    makes Spark aggregate by sorting.
    """
    best = F.max_by(F.struct(*df.columns), F.struct(version, *then))
    return df.groupBy(key).agg(best.alias("best")).select("best.*")


def is_newer(batch: Column, stored: Column, null_is_oldest: bool = False) -> Column:
    """Strictly newer. A missing revision on either side is never newer,
    unless ``null_is_oldest`` lets a known one replace a stored NULL."""
    newer = batch > stored
    if null_is_oldest:
        newer = newer | (stored.isNull() & batch.isNotNull())
    return F.coalesce(newer, F.lit(False))


def outcome(stored_id: Column, batch: Column, stored: Column, null_is_oldest: bool = False) -> Column:
    """insert, update, or keep."""
    return (
        F.when(stored_id.isNull(), "insert")
        .when(is_newer(batch, stored, null_is_oldest), "update")
        .otherwise("keep")
    )


def merge_probe(batch: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows to insert, rows to update, time span of the batch (one row per id each).

    The target is first cut to the batch's ids, which a small batch does by
    broadcast: a left join alone could only broadcast the huge side.
    """
    stored = target.select("id", F.col("updated").alias("stored_updated"))
    stored = stored.join(batch.select("id"), "id", "left_semi").withColumn("stored_id", F.col("id"))
    joined = batch.select("id", "event_time", "updated").join(stored, "id", "left")
    verdict = outcome(F.col("stored_id"), F.col("updated"), F.col("stored_updated"))
    return joined.agg(
        F.count_if(verdict == "insert").alias("to_insert"),
        F.count_if(verdict == "update").alias("to_update"),
        F.min("event_time").alias("min_time"),
        F.max("event_time").alias("max_time"),
    )


def integrity(catalog: DataFrame) -> DataFrame:
    """One row: rows, distinct ids, time span, and whether ids are unique."""
    return catalog.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("id").alias("distinct_ids"),
        F.min("event_time").alias("earliest"),
        F.max("event_time").alias("latest"),
    ).withColumn("unique_ids", F.col("total_rows") == F.col("distinct_ids"))
