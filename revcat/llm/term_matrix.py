"""A sparse document-term matrix in compressed rows (CSR), over one dictionary of all words.

A map task cuts its documents into blocks of bounded bytes and counts each
document's words against the vocabulary of its block. The vocabularies, not the
texts, are dealt by hash to tasks of bounded size, each word once per block and
many words to a row. Such a task numbers its distinct words, and the numbers go
back to the shards of the block, whose column numbers are then replaced by the
global ones.

A block is handed on in rows of about a megabyte, its shards and parts of
its vocabulary, since what an executor buffers outside its heap follows the widest
row. A shard is ``rows`` (the kept columns of its documents), ``indptr`` (where
each document's entries start), ``indices`` (global word numbers, ascending within
a document) and ``counts``. Word numbers are unique, with few gaps.

Words are runs of anything but the six ASCII white spaces. Null text counts as
empty; a document without words is a row without entries. An empty table gives no
shards and an empty dictionary. A text of any length is one row; it is split piece
by piece, at white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from revcat.llm.common import small_batches, whole_text
from revcat.session import written

#: A block is closed beyond so many bytes of text or so many documents.
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 1 << 16
#: Bytes of documents in a shard, and of words in a row; one document or word may be more.
ROW_BYTES = 1 << 20
#: How rows of that size are stored: pages and row groups, held whole by writers and readers, else have 100 rows at least.
STORED = {
    "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
}
#: Bytes of a text whose words are held as objects at once.
PIECE_BYTES = 1 << 20
#: Words of block vocabularies, repeats between blocks included, that one task numbers.
WORDS_PER_PART = 1 << 19

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes, cut at white space only."""
    start = 0
    while len(text) - start > size:
        cut = _SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _starts(sizes: np.ndarray, size: int) -> list[int]:
    """Where runs of about ``size`` begin."""
    return np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // size, prepend=-1)).tolist()


def _blocks(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Shards of every block, and the words they are counted by in rows with ``n_words``; ``at`` is the place in the block.

    Words are in the order of their hashes, parted by spaces; a shard has their places.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    given = docs.select(row.alias("row"), whole_text(f"`{text_col}`").alias("text"))
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("at", T.LongType()),
        T.StructField("rows", T.ArrayType(given.schema["row"].dataType)), T.StructField("indptr", longs),
        T.StructField("indices", ints), T.StructField("counts", ints),
        T.StructField("n_words", T.LongType()), T.StructField("words", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        words, rows, entries, size = _Vocabulary(), [], [], 0

        def handed(at: int, *columns: pa.Array | None) -> pa.RecordBatch:
            columns = [pa.array([block]), pa.array([at]), *columns]
            return pa.RecordBatch.from_arrays([pa.nulls(1, f.type) if c is None else c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        def out() -> Iterator[pa.RecordBatch]:
            named = list(words)
            order = np.argsort(_hashes(named))
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            named = [named[i] for i in order.tolist()]
            starts = _starts(np.fromiter(map(len, named), np.int64, len(named)) + 1, ROW_BYTES)
            for a, b in zip(starts, [*starts[1:], len(named)]):
                yield handed(a, None, None, None, None, pa.array([b - a]), pa.array([b" ".join(named[a:b])], pa.binary()))
            kept, lengths = pa.concat_arrays(rows), np.array([len(i) for i, _ in entries], np.int64)
            starts = _starts(8 * lengths + kept.nbytes // len(kept), ROW_BYTES)
            for a, b in zip(starts, [*starts[1:], len(entries)]):
                indptr = np.concatenate([[0], np.cumsum(lengths[a:b])])
                indices, counts = (np.concatenate([e[k] for e in entries[a:b]]) for k in (0, 1))
                yield handed(
                    a, _one_list(kept.slice(a, b - a)), _one_list(pa.array(indptr)), _one_list(pa.array(place[indices])),
                    _one_list(pa.array(counts.astype(np.int32))), None, None,
                )

        for batch in batches:
            start = 0
            for at, text in enumerate(batch.column(1)):
                raw = text.as_py().encode()
                numbers = [
                    np.fromiter(map(words.__getitem__, part), np.int64, len(part)) for part in map(bytes.split, pieces(raw))
                ]
                entries.append(np.unique(np.concatenate(numbers), return_counts=True))
                size += len(raw)
                if size >= BLOCK_BYTES or len(entries) == BLOCK_DOCS:
                    rows.append(batch.column(0).slice(start, at + 1 - start))
                    yield from out()
                    block, start, size = block + 1, at + 1, 0
                    words, rows, entries = _Vocabulary(), [], []
            if start < batch.num_rows:
                rows.append(batch.column(0).slice(start))
        if entries:
            yield from out()

    small_batches(docs.sparkSession)
    return given.mapInArrow(count, schema)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _numbered(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, at, numbers) for the words of every block, and (part, null, null, null, words) with those so numbered in a part."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, at, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = blob.as_py().split()
                part = ((_hashes(words) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                starts = np.flatnonzero(np.diff(part, prepend=part[0] + np.uint64(1))).tolist()
                ends = [*starts[1:], len(words)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[starts].astype(np.int64)), pa.array([block] * len(starts), pa.int64()), pa.array([at + a for a in starts], pa.int64()),
                    pa.array([b" ".join(words[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                ], ["part", "block", "at", "words"])

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        place = _Vocabulary()
        numbers = []
        for blob in rows["words"]:
            words = blob.split()
            numbers.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)).tobytes())
        own = pd.DataFrame({"part": rows["part"], "block": rows["block"].astype("Int64"), "at": rows["at"].astype("Int64"), "numbers": numbers, "words": None})
        none = pd.array([None], "Int64")
        named = pd.DataFrame({"part": own["part"][:1], "block": none, "at": none, "numbers": None, "words": [b" ".join(place)]})
        return pd.concat([own, named], ignore_index=True)

    dealt = blocks.where("n_words > 0").select("block", "at", "words").mapInArrow(deal, "part long, block long, at long, words binary")
    numbered = dealt.groupBy("part").applyInPandas(number, "part long, block long, at long, numbers binary, words binary")
    return written(numbered, "dictionary", STORED)


def matrix(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(dictionary, shards): word and term; rows, indptr, indices and counts.

    ``keep`` names the columns that documents carry into ``rows``; all but the text
    if not given. They live in a struct, so they may have any name.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    blocks = written(_blocks(docs, text_col, keep), "blocks", STORED)
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = 1 + words // WORDS_PER_PART
    numbered = _numbered(blocks, parts)
    dictionary = numbered.where("block IS NULL").select("part", F.posexplode(F.split(F.decode("words", "UTF-8"), " ")).alias("at", "word"))
    dictionary = dictionary.select("word", (F.col("at").cast("long") * parts + F.col("part")).alias("term"))
    shards = blocks.where("n_words IS NULL").drop("n_words", "words")
    numbers = numbered.where("block IS NOT NULL").drop("words")
    # A block's numbers, in the order of its words, come before its shards.
    local = shards.unionByName(numbers, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", F.isnull("numbers"), "at")
    schema = T.StructType([
        local.schema["rows"], local.schema["indptr"], T.StructField("indices", T.ArrayType(T.LongType())), local.schema["counts"],
    ])
    arrow = to_arrow_schema(schema)

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, numbers = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                if block != one["block"][0].as_py():
                    block, numbers = one["block"][0].as_py(), []
                if one["numbers"][0].is_valid:
                    numbers.append(np.frombuffer(one["numbers"][0].as_py(), np.int32).astype(np.int64) * parts + one["part"][0].as_py())
                    continue
                indptr, indices, counts = (one[c][0].values.to_numpy() for c in ("indptr", "indices", "counts"))
                if len(indices):
                    numbers = [np.concatenate(numbers)]
                    terms = numbers[0][indices]
                    # A block has at most BLOCK_DOCS rows, 16 bits; words have 47.
                    order = np.argsort((np.repeat(np.arange(len(indptr) - 1), np.diff(indptr)) << 47) | terms)
                    indices, counts = terms[order], counts[order]
                columns = [one["rows"], one["indptr"], _one_list(pa.array(indices, pa.int64())), _one_list(pa.array(counts, pa.int32()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return dictionary, local.mapInArrow(renumber, schema)


def row_statistics(shards: DataFrame) -> DataFrame:
    """One row per document: ``row`` (its kept columns), n_words (row sum) and n_distinct (entries)."""
    schema = T.StructType([
        T.StructField("row", shards.schema["rows"].dataType.elementType),
        T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType()),
    ])
    arrow = to_arrow_schema(schema)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                indptr, counts = (batch[c][k].values.to_numpy() for c in ("indptr", "counts"))
                upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[indptr]
                columns = [batch["rows"][k].values, pa.array(np.diff(upto)), pa.array(np.diff(indptr))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return shards.select("rows", "indptr", "counts").mapInArrow(sums, schema)
