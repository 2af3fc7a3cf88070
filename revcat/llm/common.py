"""What several operators share: words, folding, binding an expression once, batch sizes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of text in one Arrow batch, so that very long texts do not pile up in a worker.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Bound what one Arrow batch holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def whole_text(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def fold(text: Column) -> Column:
    """A-Z in lower case and nothing else, unlike lower()."""
    return F.translate(text, UPPER, UPPER.lower())


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once however often they are used.

    The optimizer copies a projected expression into filters and later
    projections; it does not look through a generator.
    """
    bound = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", bound)


def unused(prefix: str, taken: Iterable[str]) -> str:
    """A column name that clashes with none of those taken."""
    lower, name = {t.lower() for t in taken}, prefix
    while name.lower() in lower:
        name += "_"
    return name
