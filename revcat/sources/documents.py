"""Feature-collection documents, landed as files, read as VARIANT.

VARIANT keeps each JSON value's type, which the lenient coercions depend on
(100.9 and "100.9" mean different things). A broken document reads as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _options(reader, whole_files: bool):
    return (
        reader.format("json")
        .option("singleVariantColumn", "document")
        .option("multiLine", str(whole_files).lower())
    )


def _with_origin(docs: DataFrame) -> DataFrame:
    return docs.select("document", F.col("_metadata.file_path").alias("file"))


def read_documents(spark: SparkSession, path: str, whole_files: bool = True, **options) -> DataFrame:
    """(document, file): one document per file, or per line with ``whole_files=False``.

    ``options`` go to the file source, such as ``modifiedAfter`` for a folder
    where documents pile up.
    """
    return _with_origin(_options(spark.read.options(**options), whole_files).load(path))


def stream_documents(spark: SparkSession, path: str, whole_files: bool = True, **options) -> DataFrame:
    """The same source as a stream over files landing in ``path``."""
    return _with_origin(_options(spark.readStream.options(**options), whole_files).load(path))


def broken_documents(docs: DataFrame) -> DataFrame:
    """Files that hold a document which is not JSON."""
    return docs.where(F.col("document").isNull()).select("file")


def features(docs: DataFrame, on_broken: str = "fail") -> DataFrame:
    """One row per feature with its place in the delivery; no list, no rows.

    ``generated`` is the time the document itself states, if it does; ``line``
    grows with the lines of one file, as long as ``docs`` come as they were read.
    A document that is not JSON fails the job, or gives no rows with
    ``on_broken="skip"`` (``broken_documents`` then tells which).
    """
    listed = F.try_variant_get("document", "$.features", "array<variant>")
    if on_broken == "fail":
        message = F.concat(F.lit("not a JSON document: "), F.col("file"))
        listed = F.when(F.col("document").isNull(), F.raise_error(message)).otherwise(listed)
    generated = F.try_variant_get("document", "$.metadata.generated", "bigint").alias("generated")
    numbered = docs.select("file", generated, F.monotonically_increasing_id().alias("line"), listed.alias("listed"))
    return numbered.select("file", "generated", "line", F.posexplode("listed").alias("position", "feature"))
