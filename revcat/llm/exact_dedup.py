"""Exact duplicates by sorting contents.

Sampled splitters deal the rows out by content, an external sort in each
partition places equal texts side by side, and each text is compared in full with
the one before it. The range key is the first characters of the text, its digest
and the identifier: it is bounded however long texts are, keeps equal texts
adjacent, and lets a group that holds a third of all rows spread over many
partitions. The pieces of such a group are joined by digest afterwards, one row
per piece.

Null text counts as empty. Of equal texts the row with the largest identifier
stays (a null identifier is the smallest; among rows that repeat an identifier
exactly one stays). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revcat.llm.common import fold, small_batches, whole_text
from revcat.session import written

#: Characters of the text in the range key; the digest orders what agrees in them.
HEAD = 32


def _contents_sorted(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Rows as (row, id, norm, digest), equal texts adjacent. ``row``: the input row, if carried."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("boolean")
    keyed = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    keyed = keyed.select(
        "row", "id", "text", F.left(fold(F.col("text")), F.lit(HEAD)).alias("head"),
        F.unhex(F.sha2(fold(F.col("text")), 256)).alias("digest"),
    )
    if carry:  # the text travels once, inside its row
        keyed = keyed.drop("text")
    placed = keyed.repartitionByRange("head", "digest", "id")
    text = whole_text(f"row.`{text_col}`") if carry else F.col("text")
    placed = placed.select("row", "id", "digest", "head", fold(text).alias("norm"))
    return placed.sortWithinPartitions("head", "digest", "norm", "id").drop("head")


def _marker(ends_only: bool, schema: pa.Schema):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number the runs of equal neighbours; a row is known to end its run when the next one differs."""
        piece = TaskContext.get().partitionId()
        run, size, before, held = -1, 0, None, None

        def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.filter(rows["ends"]) if ends_only else rows
            yield from rows.cast(schema).to_batches()

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            norm = batch.column("norm").cast(pa.large_string())
            same = [before is not None and norm[0].as_py() == before]
            same += pc.equal(norm[1:], norm[:-1]).to_pylist()
            runs, sizes = [], []
            for equal in same:
                run, size = (run, size + 1) if equal else (run + 1, 1)
                runs.append(run)
                sizes.append(size)
            before = norm[n - 1].as_py()
            rows = pa.table({
                "row": batch.column("row"), "id": batch.column("id"), "digest": batch.column("digest"),
                "piece": pa.array([piece] * n, pa.int32()), "run": pa.array(runs, pa.int64()),
                "size": pa.array(sizes, pa.int64()),
                "ends": pa.array([not equal for equal in same[1:]] + [True], pa.bool_()),
            })
            if held is not None:
                ends = pa.array([not same[0]], pa.bool_())
                yield from out(held.set_column(held.schema.get_field_index("ends"), "ends", ends))
            yield from out(rows.slice(0, n - 1))
            held = rows.slice(n - 1)
        if held is not None:
            yield from out(held)

    return mark


def _marked(docs: DataFrame, id_col: str, text_col: str, carry: bool, ends_only: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    ordered = _contents_sorted(docs, id_col, text_col, carry)
    schema = T.StructType([
        T.StructField("row", ordered.schema["row"].dataType), T.StructField("id", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("piece", T.IntegerType()),
        T.StructField("run", T.LongType()), T.StructField("size", T.LongType()), T.StructField("ends", T.BooleanType()),
    ])
    return written(ordered.mapInArrow(_marker(ends_only, to_arrow_schema(schema)), schema), "exact")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (SHA-256 of the folded text)."""
    marked = _marked(docs, id_col, text_col, carry=False, ends_only=False)
    ends = marked.where("ends")
    # One row per piece of a group: a group is in more than one only where it crosses a splitter.
    groups = ends.groupBy("digest").agg(
        F.max(F.struct("piece", "run", "id")).alias("last"), F.sum("size").alias("group_size")
    )
    runs = ends.select("piece", "run", "digest").join(groups, "digest").select(
        "piece", "run", "group_size", F.col("last.id").alias("keep_id"),
        ((F.col("last.piece") == F.col("piece")) & (F.col("last.run") == F.col("run"))).alias("is_last"),
    )
    return marked.join(runs, ["piece", "run"]).select(
        "id", "keep_id", "group_size", (F.col("ends") & F.col("is_last")).alias("kept"), "digest"
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    ends = _marked(docs, id_col, text_col, carry=True, ends_only=True)
    # Pieces of a group other than its last; at most one row per partition, joined by its two numbers.
    last = F.max(F.struct("piece", "run")).alias("last")
    split = ends.groupBy("digest").agg(last, F.count("*").alias("pieces")).where("pieces > 1")
    lost = ends.select("digest", "piece", "run").join(split, "digest").where(
        (F.col("piece") != F.col("last.piece")) | (F.col("run") != F.col("last.run"))
    )
    return ends.join(lost.select("piece", "run"), ["piece", "run"], "left_anti").select("row.*")
