"""Byte-level BPE: every distinct word of the corpus is encoded once.

Texts are split by the tokenizer's pattern and gathered into blocks of documents;
a block keeps the position of each word as an index into its own list of distinct
words. These lists meet in a global shuffle by word, where each distinct word is
merged once; the ids return to the blocks that asked, and a block reassembles its
documents by position. What crosses the network is one entry per block and
distinct word, and the packed positions, never a row per word. Decoding joins ids
with the token-byte table.

The vocabulary (a rank file, bounded by its own size) is the only thing broadcast.
Blocks end after BLOCK_CHARS characters, so a worker's memory does not depend on
the table; one longer text is a block of its own. Null text counts as empty and
has no ids. Rows are encoded one by one, so repeated rows and identifiers are
kept, and a null identifier stays null.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revcat.llm.common import small_batches, whole_text

BLOCK_CHARS = 8 << 20
#: Characters of text whose distinct words one task of the global shuffle encodes.
CHARS_PER_PART = 16 << 20
#: From this length on a word's merges are kept in a heap; below, scanning a list is faster.
LONG_WORD = 256

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """A rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encode_word(word: bytes, ranks: Ranks) -> list[int]:
    """Merge the adjacent pair of lowest rank, the leftmost of equals, until none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return _by_scan(word, ranks) if len(word) < LONG_WORD else _by_heap(word, ranks)


def _by_scan(word: bytes, ranks: Ranks) -> list[int]:
    none = sys.maxsize
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _by_heap(word: bytes, ranks: Ranks) -> list[int]:
    end = list(range(1, len(word) + 1))  # of the part that starts here; 0: no part starts here
    before = list(range(-1, len(word)))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        if start >= 0 and end[start] < len(word):
            rank = ranks.get(word[start : end[end[start]]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[end[start]]))

    for start in range(len(word) - 1):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        if not end[start] or end[start] >= len(word) or end[end[start]] != stop:
            continue  # one of the two has changed since
        end[end[start]], end[start] = 0, stop
        if stop < len(word):
            before[stop] = start
        offer(before[start])
        offer(start)
    out, start = [], 0
    while start < len(word):
        out.append(ranks[word[start : end[start]]])
        start = end[start]
    return out


#: White space as the pattern's own engine has it: unlike Python's, without the four separators at 0x1C.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Last character for which the standard library's faster engine is used.
PLAIN_END = 0x24F


@lru_cache(maxsize=None)
def _splitters(pattern: str):
    """The pattern for any text, the same for plain text, and what tells a text is not plain.

    The plain form has the letters and digits spelt out for the characters up to
    PLAIN_END, and words first: what it moves ahead starts with another character.
    """
    general = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
    known = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    if pattern != known:
        return general, None, None

    def spelt(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(PLAIN_END + 1) if unicodedata.category(chr(c))[0] == kind)

    letters, digits = spelt("L"), spelt("N")
    plain = re.compile(
        f" ?[{letters}]+| ?[{digits}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{SPACE}{letters}{digits}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )
    return general, plain, re.compile(f"[^\\x00-\\u{PLAIN_END:04x}]")


def split_words(text: str, pattern: str) -> list[str]:
    general, plain, exotic = _splitters(pattern)
    return (general if plain is None or exotic.search(text) else plain).findall(text)


def _pack(array: np.ndarray) -> bytes:
    """Byte planes, compressed one by one: the high ones are nearly all zero."""
    raw = np.ascontiguousarray(array, "<u4").view(np.uint8).reshape(-1, 4)
    planes = [zstandard.compress(raw[:, k].tobytes(), 1) for k in range(4)]
    return b"".join(len(p).to_bytes(4, "little") + p for p in planes)


def _unpack(packed: bytes) -> np.ndarray:
    planes, at = [], 0
    for _ in range(4):
        size = int.from_bytes(packed[at : at + 4], "little")
        planes.append(np.frombuffer(zstandard.decompress(packed[at + 4 : at + 4 + size]), np.uint8))
        at += 4 + size
    return np.stack(planes, axis=1).reshape(-1).view("<u4") if len(planes[0]) else np.zeros(0, "<u4")


def _pack_words(words: list[bytes]) -> bytes:
    sizes = _pack(np.fromiter(map(len, words), np.uint32, len(words)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(words), 1)


def _unpack_words(packed: bytes) -> list[bytes]:
    size = int.from_bytes(packed[:4], "little")
    ends = np.cumsum(_unpack(packed[4 : 4 + size]), dtype=np.int64).tolist()
    joined = zstandard.decompress(packed[4 + size :])
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


BLOCK_SCHEMA = "block long, packed binary"


def _join_parts(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _take_parts(packed: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(packed):
        size = int.from_bytes(packed[at : at + 8], "little")
        parts.append(packed[at + 8 : at + 8 + size])
        at += 8 + size
    return parts


def _blocks(docs: DataFrame, id_col: str, text_col: str, pattern: str) -> DataFrame:
    """Documents in blocks: the distinct words, and each word's index in them, in order.

    A block is one opaque value, so that both who reads its words and who reads its
    positions want the same column, and one shuffle serves both.
    """
    schema = pa.schema([("block", pa.int64()), ("packed", pa.binary())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, lengths, positions, chars = [], [], [], 0
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__

        def block() -> pa.RecordBatch:
            every = np.concatenate(positions) if positions else np.zeros(0, np.uint32)
            order = np.argsort(-np.bincount(every, minlength=len(index)), kind="stable")
            rank = np.empty(len(index), np.uint32)
            rank[order] = np.arange(len(index), dtype=np.uint32)
            words = list(index)
            packed = _join_parts(
                _pack_words([words[i].encode() for i in order.tolist()]), _pack(rank[every]), _pack(np.array(lengths, np.uint32)),
                np.array([-1 if i is None else i for i in ids], np.int64).tobytes(), np.array([i is None for i in ids], np.bool_).tobytes(),
            )
            return pa.RecordBatch.from_pylist([{"block": number, "packed": packed}], schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = split_words(text.as_py(), pattern)
                ids.append(doc)
                lengths.append(len(words))
                positions.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
                chars += len(text.as_py()) + 1
                if chars >= BLOCK_CHARS:
                    yield block()
                    ids, lengths, positions, chars = [], [], [], 0
                    index.clear()
                    number += 1
        if ids:
            yield block()

    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    return plain.mapInArrow(split, BLOCK_SCHEMA)


def _encoded_words(blocks: DataFrame, ranks: Broadcast, parts: int) -> DataFrame:
    """(block, mark, at, counts, tokens): which of the block's words, ids per word, and the ids; mark: of its word list."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _take_parts(packed.as_py())[0]
                words, mark = _unpack_words(own), zlib.crc32(own)
                part = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % parts
                order = np.argsort(part, kind="stable")
                starts = np.flatnonzero(np.diff(part[order], prepend=-1))
                for at in np.split(order, starts[1:]):
                    if len(at):
                        chosen = [words[i] for i in at.tolist()]
                        row = [[int(part[at[0]])], [block], [mark], [_pack(at.astype(np.uint32))], [_pack_words(chosen)]]
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["part", "block", "mark", "at", "words"])

    def encode(group: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, list[int]] = {}
        table = ranks.value
        counts, tokens = [], []
        for packed in group["words"]:
            ids = []
            for word in _unpack_words(packed):
                found = known.get(word)
                if found is None:
                    found = known[word] = encode_word(word, table)
                ids.append(found)
            counts.append(_pack(np.fromiter(map(len, ids), np.uint32, len(ids))))
            tokens.append(_pack(np.fromiter((t for x in ids for t in x), np.uint32)))
        return pd.DataFrame({"block": group["block"], "mark": group["mark"], "at": group["at"], "counts": counts, "tokens": tokens})

    dealt = blocks.mapInArrow(deal, "part long, block long, mark long, at binary, words binary")
    return dealt.groupBy("part").applyInPandas(encode, "block long, mark long, at binary, counts binary, tokens binary")


def _assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block, from its positions and the ids of its words."""
    out: tuple[list, list, list] = ([], [], [])
    for packed in left["packed"]:
        own, positions, lengths, doc_ids, missing = _take_parts(packed)
        if (right["mark"] != zlib.crc32(own)).any():
            raise RuntimeError("the rows came in another order when the stage ran again; read the documents from a table")
        n_words = len(_unpack_words(own))
        counts = np.zeros(n_words, np.int64)
        at = [_unpack(a) for a in right["at"]]
        each = [_unpack(c).astype(np.int64) for c in right["counts"]]
        for where, count in zip(at, each):
            counts[where] = count
        flat = np.concatenate([np.zeros(0, "<u4"), *map(_unpack, right["tokens"])])
        # Where the ids of each word start in ``flat``.
        starts, done = np.zeros(n_words, np.int64), 0
        for where, count in zip(at, each):
            starts[where] = done + np.cumsum(count) - count
            done += int(count.sum())
        words, lengths = _unpack(positions), _unpack(lengths).astype(np.int64)
        doc_ids = pd.array(np.frombuffer(doc_ids, np.int64), "Int64")
        doc_ids[np.frombuffer(missing, np.bool_)] = pd.NA
        stops = np.cumsum(lengths)
        for doc, stop, length in zip(doc_ids, stops.tolist(), lengths.tolist()):
            own = words[stop - length : stop]
            n = counts[own]
            ends = np.cumsum(n)
            total = int(ends[-1]) if length else 0
            ids = flat[np.repeat(starts[own] - (ends - n), n) + np.arange(total)]
            out[0].append(doc)
            out[1].append(total)
            out[2].append(ids.astype("<u4").tobytes())
    return pd.DataFrame({"id": pd.array(out[0], "Int64"), "n_tokens": out[1], "tokens": out[2]})


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per document: id, n_tokens, tokens (ids as little-endian unsigned 32-bit integers).

    With ``decoded`` also what ``decode`` gives, in the same Python worker: one per task, not two.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(docs, id_col, text_col, pattern).repartition(parts, "block")
    encoded = _encoded_words(blocks, ranks, max(1, -(-chars // CHARS_PER_PART)))
    both = blocks.groupBy("block").cogroup(encoded.groupBy("block"))
    schema = "id long, n_tokens long, tokens binary"
    if not decoded:
        return both.applyInPandas(_assemble, schema)
    pieces = _pieces(spark, vocabulary)

    def assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = _assemble(left, right)
        return out.assign(decoded=_decoded(out["tokens"], pieces.value))

    return both.applyInPandas(assemble, schema + ", decoded binary")


def _pieces(spark: SparkSession, vocabulary: str) -> Broadcast:
    """The bytes of each id; one entry per token of the vocabulary."""
    return spark.sparkContext.broadcast({rank: token for token, rank in read_ranks(vocabulary).items()})


def _decoded(tokens: Iterable[bytes | None], pieces: dict[int, bytes]) -> list[bytes]:
    return [b"".join([pieces[i] for i in np.frombuffer(t or b"", "<u4").tolist()]) for t in tokens]


def decode(encoded: DataFrame, vocabulary: str, tokens_col: str = "tokens") -> DataFrame:
    """``encoded`` with one more column ``decoded``: the bytes of its ids. An unknown id is an error."""
    pieces = _pieces(encoded.sparkSession, vocabulary)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(tokens_col))
            texts = _decoded((t.as_py() for t in column), pieces.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    small_batches(encoded.sparkSession)
    return encoded.mapInArrow(join, schema)


def encoded_digests(spark: SparkSession, docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = encode(docs, vocabulary, pattern, decoded=True)
    return coded.select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
