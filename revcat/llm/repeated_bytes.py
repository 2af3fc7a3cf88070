"""Removal of bytes in repeated strings, by minimizer fingerprints in place of prefix doubling.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else too.
There are no rank pairs and no growing offsets: positions are fingerprinted at
three fixed lengths, and what is unique at one is not looked at again:

* The first round only takes anchors: positions whose KEY-byte prefix has the
  smallest hash in some string of LENGTH bytes. Equal strings have equal smallest
  hashes, so a start whose smallest hash is not repeated is unique.
* The same round takes, for each anchor, the prefix that spans every string that
  starts before the next anchor. Where that one is repeated, all those are.
* Only starts next to the ends of repeated stretches are left; the last round
  takes their whole LENGTH bytes, with the starts that are known to be
  repeated and have the same smallest hash, since they may repeat one of those.

A rank is a 64-bit polynomial hash of the prefix. Keys only narrow down where to
look; spans and whole strings, which decide, count as equal if 32 bits of a second
hash with its own byte values and factor are equal too (96 bits). Ranks meet as sorted
arrays of differences, one entry per block of documents and distinct rank, so a string
that occurs millions of times is one entry per block. The answer has the second hash
only of ranks that are those of several strings. The texts are shuffled once, in blocks, and each
round reads that one shuffle.

Null and short texts are left as they are. Rows that repeat an identifier are
separate documents. Matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import small_batches, whole_text

LENGTH, KEY = 200, 64
SPAN = LENGTH - KEY + 1  # key positions in a string
BLOCK_BYTES = 4 << 20
BYTES_PER_PART = 16 << 20

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_FACTOR, _CHECK_FACTOR = 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F
#: The kinds whose ranks come with the second hash.
CHECKED = ("span", "start")
#: Ends the kind of an answer whose ranks are those of several strings; only it has the second hash.
SHARED = "+"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))
_CHECK_BYTE = _mix(np.arange(257, 513, dtype=np.uint64))


@lru_cache(maxsize=8)
def _powers(size: int, factor: int) -> tuple[np.ndarray, np.ndarray]:
    def of(factor: int) -> np.ndarray:
        out = np.full(size, factor, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(factor), of(pow(factor, -1, 1 << 64))


class _Hash:
    """Polynomial hashes of the substrings of a document."""

    def __init__(self, data: np.ndarray, byte: np.ndarray, factor: int):
        n = len(data)
        up, self._down = _powers(max(1 << 12, 1 << n.bit_length()), factor)
        values = byte[data] * up[:n]
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])

    def __call__(self, at: np.ndarray, length) -> np.ndarray:
        """Of the ``length`` bytes from each position on."""
        raw = (self._sums[at + length] - self._sums[at]) * self._down[at]
        return _mix(raw ^ (np.asarray(length).astype(np.uint64) * _B))


class Text:
    """A document of LENGTH bytes or more, its anchors and their ranks."""

    def __init__(self, data: bytes):
        n = len(data)
        self._data = np.frombuffer(data, np.uint8)
        self.rank = _Hash(self._data, _BYTE, _FACTOR)
        self.n_starts = n - LENGTH + 1
        keys = self.rank(np.arange(n - KEY + 1), KEY)
        least = _slide(keys, np.minimum)  # of each string
        self.runs = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.run_keys = _mix(least[self.runs])  # smallest hashes are small: spread them again
        edge = np.zeros(SPAN - 1, np.uint64)
        most = _slide(np.concatenate([edge, least, edge]), np.maximum)
        self.at = np.flatnonzero(keys == most)
        self.keys = _mix(keys[self.at])
        # The anchor whose key ends all strings that start before the next anchor.
        self.last = np.searchsorted(self.at, self.at[1:] + SPAN - 1)
        has = self.last < len(self.at)
        self.spanned = np.flatnonzero(has)
        self.span_at = self.at[:-1][has]
        self.span_length = self.at[self.last[has]] + KEY - self.span_at
        self.spans = self.rank(self.span_at, self.span_length)

    @cached_property
    def _check(self) -> _Hash:
        return _Hash(self._data, _CHECK_BYTE, _CHECK_FACTOR)

    def check(self, at: np.ndarray, length) -> np.ndarray:
        """The second hash of the ``length`` bytes from each position on."""
        return (self._check(at, length) >> np.uint64(32)).astype(np.uint32)

    def confirmed(self, repeated: "_Ranks", kind: str, ranks: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which of the strings are repeated by both hashes."""
        out = repeated.has(kind, ranks)
        doubtful = np.flatnonzero(repeated.has(kind + SHARED, ranks))
        if len(doubtful):
            out[doubtful] = repeated.has(kind + SHARED, ranks[doubtful], self.check(at[doubtful], length[doubtful]))
        return out

    def starts(self, repeated: "_Ranks") -> tuple[np.ndarray, np.ndarray]:
        """Of each start: may it be repeated, and is it known to be."""
        n = self.n_starts
        open_ = np.repeat(repeated.has("key", self.run_keys), np.diff(np.append(self.runs, n)))
        known = np.zeros(n + 1, np.int64)
        good = self.spanned[self.confirmed(repeated, "span", self.spans, self.span_at, self.span_length)]
        np.add.at(known, np.minimum(self.at[good], n), 1)
        np.add.at(known, np.minimum(self.at[good + 1], n), -1)
        return open_, (np.cumsum(known[:-1]) > 0) & open_

    def least_key(self, starts: np.ndarray) -> np.ndarray:
        """The smallest hash in the string at each start."""
        return self.run_keys[np.searchsorted(self.runs, starts, side="right") - 1]


def _slide(values: np.ndarray, of: Callable) -> np.ndarray:
    """The smallest or largest of each SPAN neighbours."""
    width = 1
    while 2 * width <= SPAN:
        values, width = of(values[:-width], values[width:]), 2 * width
    rest = SPAN - width
    return of(values[: len(values) - rest], values[rest:]) if rest else values


class _Ranks:
    """Ranks by kind, as sorted arrays, with their second hashes."""

    def __init__(self, rows: pd.DataFrame):
        self.sets = {
            kind: _distinct(*_joined([_decoded(r, kind.endswith(SHARED)) for r in some]))[:2] for kind, some in rows.groupby("kind")["ranks"]
        }

    def has(self, kind: str, ranks: np.ndarray, checks: np.ndarray | None = None) -> np.ndarray:
        known, known_checks = self.sets.get(kind, (ranks[:0], None))
        return _among(ranks, known, checks, known_checks)


def _coded(ranks: np.ndarray, checks: np.ndarray | None) -> bytes:
    """Sorted ranks as differences, byte by byte, so that the shuffle's compression finds the high ones to be zero."""
    steps = np.diff(ranks, prepend=np.zeros(1, np.uint64))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() + (b"" if checks is None else checks.tobytes())


def _decoded(raw: bytes, checked: bool) -> tuple[np.ndarray, np.ndarray | None]:
    n = len(raw) // (12 if checked else 8)
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), np.frombuffer(raw, np.uint32, n, 8 * n) if checked else None


def _joined(pairs: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray | None]:
    ranks = np.concatenate([np.zeros(0, np.uint64), *[r for r, _ in pairs]])
    checked = pairs and pairs[0][1] is not None
    return ranks, np.concatenate([c for _, c in pairs]) if checked else None


def _distinct(ranks: np.ndarray, checks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray | None]:
    """The distinct ranks (with checks: pairs) in order, how many there are of each, and the order of all pairs."""
    if checks is None:
        distinct, counts = np.unique(ranks, return_counts=True)
        return distinct, None, counts, None
    order = np.argsort(ranks)
    first, second = ranks[order], checks[order]
    if ((first[1:] == first[:-1]) & (second[1:] != second[:-1])).any():  # a rank is that of several strings
        order = np.lexsort((checks, ranks))
        first, second = ranks[order], checks[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(first)), bool), (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
    return first[starts], second[starts], np.diff(np.append(starts, len(first))), order


def _among(ranks: np.ndarray, known: np.ndarray, checks: np.ndarray | None = None, known_checks: np.ndarray | None = None) -> np.ndarray:
    """Which of the ranks (with checks: pairs) are in the sorted array ``known``."""
    found = np.zeros(len(ranks), bool)
    if not len(known):
        return found
    at = np.searchsorted(known, ranks)
    while True:
        inside = np.minimum(at, len(known) - 1)
        same = (at < len(known)) & (known[inside] == ranks)
        if checks is None:
            return same
        found |= same & (known_checks[inside] == checks)
        if not (same & ~found).any():
            return found
        at = at + 1


def _pack(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("block", pa.int64()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def out() -> pa.RecordBatch:
            parts = [
                np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is None for i in ids], "?").tobytes(),
                np.array([len(t) for t in texts], "<i8").tobytes(), zstandard.compress(b"".join(texts), 3),
            ]
            packed = len(ids).to_bytes(8, "little") + b"".join(parts)
            return pa.RecordBatch.from_pylist([{"block": block, "packed": packed}], schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                texts.append(text.as_py().encode())
                held += len(texts[-1]) + 64
                if held >= BLOCK_BYTES:
                    yield out()
                    block, ids, texts, held = block + 1, [], [], 0
        if ids:
            yield out()

    return docs.mapInArrow(pack, "block long, packed binary")


def _unpack(packed: bytes) -> Iterator[tuple[int | None, bytes]]:
    n = int.from_bytes(packed[:8], "little")
    ids = np.frombuffer(packed, "<i8", n, 8).tolist()
    missing = np.frombuffer(packed, "?", n, 8 + 8 * n).tolist()
    sizes = np.frombuffer(packed, "<i8", n, 8 + 9 * n).tolist()
    joined, at = zstandard.decompress(packed[8 + 17 * n :]), 0
    for doc, none, size in zip(ids, missing, sizes):
        yield None if none else doc, joined[at : at + size]
        at += size


def _texts(packed: bytes) -> Iterator[Text]:
    return (Text(data) for _, data in _unpack(packed) if len(data) >= LENGTH)


ENTRIES = "part long, block long, kind string, ranks binary, many binary"


def _entries(
    block: int, kind: str, ranks: list[np.ndarray], parts: int, many: bool | None = None, checks: list[np.ndarray] | None = None
) -> Iterator[list]:
    """The distinct ranks of a block, by the task they meet in; many: does the block itself have it twice."""
    pairs = list(zip(ranks, checks)) if kind in CHECKED else [(r, None) for r in ranks]
    distinct, second, counts, _ = _distinct(*_joined(pairs))
    part = np.minimum(distinct // np.uint64(((1 << 64) - 1) // parts), np.uint64(parts - 1))  # in the order of the ranks
    twice = counts > 1 if many is None else np.full(len(part), many)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    for a, b in zip(starts, [*starts[1:], len(part)]):
        yield [int(part[a]), block, kind, _coded(distinct[a:b], None if second is None else second[a:b]), twice[a:b].tobytes()]


def _frame(rows: list[list]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "block", "kind", "ranks", "many"])


def _repeated(entries: DataFrame) -> DataFrame:
    """For each block, those of its ranks that occur at least twice in all blocks; of ``ask``, those on offer."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kinds in (("key",), ("span",), ("start",), ("ask", "offer")):
            some = rows[rows["kind"].isin(kinds)]
            if some.empty:
                continue
            pairs = [_decoded(r, kind in CHECKED) for kind, r in zip(some["kind"], some["ranks"])]
            shared = shared_checks = None
            if "ask" in kinds:
                offers = [r for (r, _), kind in zip(pairs, some["kind"]) if kind == "offer"]
                found = np.unique(np.concatenate([np.zeros(0, np.uint64), *offers]))
            else:
                every, checks = _joined(pairs)
                twice = np.concatenate([np.frombuffer(m, "?") for m in some["many"]])
                distinct, second, counts, order = _distinct(every, checks)
                if second is None:
                    found = np.union1d(distinct[counts > 1], every[twice])
                else:
                    again = (counts > 1) | np.logical_or.reduceat(twice[order], np.cumsum(counts) - counts)
                    several = np.zeros(len(distinct) + 1, bool)
                    several[1:-1] = distinct[1:] == distinct[:-1]
                    several = several[1:] | several[:-1]
                    found = distinct[again & ~several]
                    shared, shared_checks = distinct[again & several], second[again & several]
            for block, kind, (own, own_checks) in zip(some["block"], some["kind"], pairs):
                if kind != "offer" and len(hit := own[_among(own, found)]):
                    out.append((block, kind, _coded(hit, None)))
                if shared is not None and (both := _among(own, shared, own_checks, shared_checks)).any():
                    out.append((block, kind + SHARED, _coded(own[both], own_checks[both])))
        return pd.DataFrame(out, columns=["block", "kind", "ranks"])

    return entries.groupBy("part").applyInPandas(meet, "block long, kind string, ranks binary")


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that remain)."""
    spark = docs.sparkSession
    small_batches(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(1, -(-total // BYTES_PER_PART)))
    blocks = _pack(plain).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts = list(_anchors(packed.as_py()))
                keys, spans, checks = ([t[k] for t in texts] for k in range(3))
                for kind, ranks in (("key", keys), ("span", spans)):
                    for row in _entries(block, kind, ranks, parts, checks=checks):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()))],
                            ["part", "block", "kind", "ranks", "many"],
                        )

    def asks(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ranks, rows = _Ranks(right), []
        for block, packed in zip(left["block"], left["packed"]):
            ask, offer = [], []
            for text in _texts(packed):
                open_, known = text.starts(ranks)
                ask.append(np.unique(text.least_key(np.flatnonzero(known))))
                offer.append(np.unique(text.least_key(np.flatnonzero(open_ & ~known))))
            rows += [*_entries(block, "ask", ask, parts, False), *_entries(block, "offer", offer, parts, False)]
        return _frame(rows)

    def strings(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ranks, rows = _Ranks(right), []
        for block, packed in zip(left["block"], left["packed"]):
            found, checks = [], []
            for text in _texts(packed):
                open_, known = text.starts(ranks)
                starts = np.flatnonzero(open_)
                starts = starts[~known[starts] | ranks.has("ask", text.least_key(starts))]
                if len(starts):
                    found.append(text.rank(starts, LENGTH))
                    checks.append(text.check(starts, LENGTH))
            rows += _entries(block, "start", found, parts, checks=checks)
        return _frame(rows)

    def strip(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ranks, rows = _Ranks(right), []
        for packed in left["packed"]:
            for doc, data in _unpack(packed):
                if len(data) < LENGTH:
                    rows.append((doc, len(data), 0, 0, data))
                    continue
                text = Text(data)
                open_, known = text.starts(ranks)
                unsure = np.flatnonzero(open_ & ~known)
                known[unsure] = text.confirmed(ranks, "start", text.rank(unsure, LENGTH), unsure, np.full(len(unsure), LENGTH))
                edges = np.zeros(len(data) + 1, np.int64)
                hit = np.flatnonzero(known)
                np.add.at(edges, hit, 1)
                np.add.at(edges, hit + LENGTH, -1)
                gone = np.cumsum(edges[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((doc, len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
        return out.astype({"doc_id": "Int64"})

    def with_blocks(ranks: DataFrame, f: Callable, schema: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(ranks.groupBy("block")).applyInPandas(f, schema)

    first = _repeated(blocks.mapInArrow(anchors, ENTRIES))
    asked = _repeated(with_blocks(first, asks, ENTRIES))
    last = _repeated(with_blocks(first.union(asked), strings, ENTRIES))
    return with_blocks(first.union(last), strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _anchors(packed: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return ((t.keys, t.spans, t.check(t.span_at, t.span_length)) for t in _texts(packed))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    stripped = strip_repeats(docs)
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
