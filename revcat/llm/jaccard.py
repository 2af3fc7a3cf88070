"""Exact Jaccard join of word shingle sets by partitioning their universe.

Sets that link differ in at most (|A| + |B|) / 7 shingles at a similarity of 0.75.
Sizes fall into bands; for each band the universe of shingles is hashed into more
segments than that difference, so two linked sets agree on some segments in full
(pigeonhole). Per band the cheaper of two ways is allocated:

* segments: slack + difference + 1 segments; the ``slack`` smallest ones, which
  the most sets share, are skipped, and the rest is indexed. The order (size,
  then hash) is the same for both sets, so the least common segment on which two
  linked sets agree is skipped by neither.
* one-deletion neighbourhoods: half as many segments, each indexed in full and
  without each of its shingles; linked sets differ by at most one shingle in some
  segment.

Equal signatures meet in one shuffle, as arrays of 8 bytes per signature. Each set
is first compared with one other, the one that comes first under most of its
signatures. A sketch filters pairs without loss (a parity bit per slot that shingles
are hashed to: it never differs in more bits than the sets do in shingles), and what
remains is verified on the whole sets. Of a signature whose members are still in
different components, the shortest forest that joins these is verified next, nearest
sketches first: one pair less than components, however many pairs there are. The
signatures of a task have one forest together, or all their pairs if these are no more
than their members. Members that have pairs not given then, and are in different
components even so, are compared once more, with their whole sets beside them: a task
verifies the pairs itself and puts out only links that join components. So every link
between different components is found, while a group of near copies is not expanded
into its pairs, with or without a text in its middle, nor is one of texts that just fail
to link: the comparisons put out at most two rows per member. Sets that are equal are one node.

Null and empty texts, and texts without words, have an empty set and link with
nothing. Fewer words than a shingle make one shingle of all words. Rows that repeat
an identifier are judged by their own texts. A null identifier is never the
smallest of a component, unless all are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import small_batches, unused, whole_text
from revcat.llm.components import components
from revcat.session import written

SHINGLE = 5
#: Links have NUMERATOR / DENOMINATOR or more in common.
NUMERATOR, DENOMINATOR = 75, 100
BAND_GROWTH = 1.5
SLACK = 0.35
#: A sketch has at least so many bits, and at least two per shingle.
SKETCH_BITS = 256
#: Characters of text whose signatures one task of the shuffle holds.
CHARS_PER_PART = 2 << 20
#: Documents and signatures that a map task packs together; the first is the range of a 16-bit number.
FLUSH_DOCS, FLUSH_SIGNATURES = 1 << 16, 1 << 20
#: Words whose hashes a task keeps; most words are common ones, and rare ones would only fill the memory.
KEPT_WORDS = 50_000
#: Members of open signatures that one task compares, more only where one signature has them; pairs at once.
MEMBERS_PER_PART, PAIRS_AT_ONCE = 1 << 14, 1 << 16
#: Bytes of whole sets that one task compares, and that signatures are merged up to; more only where one signature has
#: them; pairs that a task remembers as no links.
SET_BYTES_PER_PART, MERGED_SET_BYTES, KEPT_PAIRS = 8 << 20, 32 << 20, 1 << 17
#: Signatures with up to so many members are compared many at a time, larger ones one at a time.
SMALL_GROUP = 128
#: Identifiers (8 bytes each) that may be broadcast; rows of several count as so many. Beyond, the same join shuffles.
BROADCAST_IDS = 250_000
#: The cost model: share of sets that have a given common shingle, and sets in a band.
COMMON, SETS_IN_BAND = 0.02, 1e6

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: A factor for each place of a word in its shingle.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, hashes: dict[bytes, int]) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.encode().translate(_FOLD).split()  # bytes.split() splits at the six ASCII white spaces
    n, k = len(words), min(len(words), SHINGLE)
    if not n:
        return np.zeros(0, np.uint64)
    of = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    rolled = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        rolled += of[i : n - k + 1 + i] * _PLACES[i]
    rolled = np.sort(_mix(rolled))
    return rolled[np.concatenate([[True], rolled[1:] != rolled[:-1]])]


def most_different(a: int, b: int) -> int:
    """Most shingles in which linked sets of these sizes can differ."""
    return (a + b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


class Band:
    """Pairs whose smaller set has low..high shingles; the larger has up to ``reach``."""

    def __init__(self, low: int, high: int):
        self.low, self.high, self.reach = low, high, high * DENOMINATOR // NUMERATOR
        self.differ = most_different(high, self.reach)
        self.slack = round(SLACK * (self.differ + 1))
        self.segments = self.differ + 1 + self.slack
        halves = self.differ // 2 + 1
        plain = self.differ + 1 + SETS_IN_BAND * COMMON ** (high / self.segments)
        deleted = halves + high + SETS_IN_BAND * COMMON ** max(0.0, high / halves - 1)
        self.delete = self.differ > 0 and deleted < plain
        if self.delete:
            self.segments, self.slack = halves, 0

        self.base = _mix(np.arange(self.segments, dtype=np.uint64) + (np.uint64(low) << np.uint64(32)))

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        segment = ((_mix(shingles ^ np.uint64(self.low)) >> np.uint64(32)) * np.uint64(self.segments)) >> np.uint64(32)
        segment, weight = segment.astype(np.int64), _mix(shingles + _B)
        totals = np.zeros(self.segments, np.uint64)
        np.add.at(totals, segment, weight)
        whole = _mix(totals ^ self.base)
        if self.delete:
            return np.concatenate([whole, _mix((totals[segment] - weight) ^ self.base[segment])])
        if not self.slack:
            return whole
        sizes = np.bincount(segment, minlength=self.segments)
        rank = (np.minimum(sizes, 255).astype(np.uint64) << np.uint64(56)) | (whole >> np.uint64(8))
        return whole[np.argpartition(rank, self.slack)[self.slack :]]


def bands(largest: int) -> Iterator[Band]:
    low = 1
    while low <= largest:
        after = max(low + 1, int(low * BAND_GROWTH))
        yield Band(low, after - 1)
        low = after


def signatures(shingles: np.ndarray, cache: list[Band]) -> np.ndarray:
    """What the set is indexed under: in its own band, and in those whose larger sets it may be."""
    n = len(shingles)
    while not cache or cache[-1].low <= n:
        cache.extend(list(bands(2 * n))[len(cache) :])
    return np.concatenate([np.zeros(0, np.uint64), *(b.signatures(shingles) for b in cache if b.low <= n <= b.reach)])


def _sketch(shingles: np.ndarray) -> bytes:
    bits = max(SKETCH_BITS, 1 << int(2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def _folded(bits: np.ndarray) -> np.ndarray:
    """The sketch of half the size: slot x holds what x and x + half held."""
    half = bits.shape[-1] // 2
    return bits[..., :half] ^ bits[..., half:]


def _differ(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = _folded(x)
    while len(y) > len(x):
        y = _folded(y)
    return int(np.bitwise_count(x ^ y).sum())


def _node(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _index(docs: DataFrame, parts: int) -> DataFrame:
    """Documents (key, doc_id, n, node, bits) and, with ``sig``, members of signatures of two or more sets."""
    packed = pa.schema([
        ("part", pa.int64()), ("flush", pa.int64()), ("sigs", pa.binary()), ("ids", pa.list_(pa.int64())),
        ("ns", pa.list_(pa.int64())), ("nodes", pa.list_(pa.binary())), ("bits", pa.list_(pa.binary())),
    ])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = TaskContext.get().partitionId() << 24
        hashes, cache, seen = _WordHashes(), [], set()
        sigs, docs, held = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            empty = dict.fromkeys(("ids", "ns", "nodes", "bits"))
            meta = dict(zip(("ids", "ns", "nodes", "bits"), map(list, zip(*docs))))
            yield pa.RecordBatch.from_pylist([{"part": -1 - ((flush >> 24) + flush) % parts, "flush": flush, "sigs": None, **meta}], packed)
            if sigs:
                # In place where it can be: a worker keeps the memory of its largest moment.
                at = np.repeat(np.array([i for _, i in sigs], np.uint16), [len(s) for s, _ in sigs])
                entry = np.concatenate([s for s, _ in sigs])
                sigs.clear()
                part = (entry % np.uint64(parts)).astype(np.int32)
                entry //= np.uint64(parts)
                entry <<= np.uint64(16)
                entry |= at
                del at
                order = np.argsort(part, kind="stable")
                part, entry = part[order], entry[order]
                del order
                starts = np.flatnonzero(np.diff(part, prepend=part[0] + 1))
                rows = [
                    {"part": int(part[a]), "flush": flush, "sigs": entry[a:b].tobytes(), **empty}
                    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)])
                ]
                yield pa.RecordBatch.from_pylist(rows, packed)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(text.as_py(), hashes)
                node = _node(shingles)
                if node is not None and node not in seen:
                    seen.add(node)
                    sigs.append((signatures(shingles, cache), len(docs)))
                    held += len(sigs[-1][0])
                docs.append((doc, len(shingles), node, _sketch(shingles) if node else None))
                if len(docs) == FLUSH_DOCS or held >= FLUSH_SIGNATURES:
                    yield from out()
                    flush, sigs, docs, held = flush + 1, [], [], 0
        if docs:
            yield from out()

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        if part < 0:
            found = []
            for row in rows.itertuples():
                found += [(None, (row.flush << 16) + i, None, *x) for i, x in enumerate(zip(row.ids, row.ns, row.nodes, row.bits))]
            return _frame(found)
        entries = [np.frombuffer(s, np.uint64) for s in rows["sigs"]]
        keys = np.concatenate([(np.uint64(f) << np.uint64(16)) | (e & np.uint64(0xFFFF)) for f, e in zip(rows["flush"], entries)])
        sig = np.concatenate([e >> np.uint64(16) for e in entries])
        order = np.lexsort((keys, sig))
        sig, keys = sig[order], keys[order].astype(np.int64)
        fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (keys[1:] != keys[:-1])])  # a set may repeat a signature
        sig, keys = sig[fresh], keys[fresh]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        sizes = np.diff(np.append(starts, len(sig)))
        group = np.repeat(np.arange(len(starts)), sizes)
        many = np.repeat(sizes > 1, sizes)
        first = np.repeat(keys[starts], sizes)
        out = pd.DataFrame({"sig": (part << 32) + group[many], "key": keys[many], "first": first[many]})
        return out.assign(doc_id=None, n=None, node=None, bits=None)

    small_batches(docs.sparkSession)
    plain = docs.select("doc_id", "text")
    dealt = plain.mapInArrow(emit, "part long, flush long, sigs binary, ids array<long>, ns array<long>, nodes array<binary>, bits array<binary>")
    schema = "sig long, key long, first long, doc_id long, n long, node binary, bits binary"
    return written(dealt.groupBy("part").applyInPandas(gather, schema), "jaccard")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = list(zip(*rows)) if rows else [[]] * 7
    names = ["sig", "key", "first", "doc_id", "n", "node", "bits"]
    return pd.DataFrame({
        name: pd.array(c, "Int64") if name not in ("node", "bits") else pd.Series(c, dtype=object) for name, c in zip(names, columns)
    })


def _fits(df: DataFrame, ids: int) -> bool:
    """Whether a written table, whose rows are as large as so many identifiers, may be broadcast."""
    return df.count() * ids <= BROADCAST_IDS


def _few(df: DataFrame, ids: int, label: str = "", of: DataFrame | None = None) -> DataFrame:
    """``df`` for a join, broadcast if it is small.

    It is written (as ``label``) to count its rows, unless it has no more of them than the written table ``of``, which is small.
    """
    if of is not None and _fits(of, ids):
        return F.broadcast(df)
    df = written(df, label) if label else df
    return F.broadcast(df) if _fits(df, ids) else df


def _near(pairs: DataFrame) -> DataFrame:
    """Pairs (node_a, n_a, bits_a, and b) whose sizes and sketches allow a link, as (u, v, n_u, n_v)."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(k).to_numpy().astype(np.int64) for k in (1, 4))
            differ = [_differ(a, b) for a, b in zip(*(batch.column(k).to_pylist() for k in (2, 5)))]
            chosen = pa.array(_may_link(n_a, n_b, np.array(differ, np.int64)), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(chosen) for k in (0, 3, 1, 4)], ["u", "v", "n_u", "n_v"])

    frame = pairs.select("node_a", "n_a", "bits_a", "node_b", "n_b", "bits_b").where("node_a <> node_b")
    kept = frame.mapInArrow(keep, "u binary, v binary, n_u long, n_v long")
    swap = F.col("u") > F.col("v")
    return kept.select(*[F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("u", "v"), ("v", "u"), ("n_u", "n_v"), ("n_v", "n_u"))])


def _may_link(n_a, n_b, differ):
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    allowed = (n_a + n_b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)
    return (small * DENOMINATOR >= large * NUMERATOR) & (differ <= allowed)


def _links(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def _sets(needed: DataFrame, docs: DataFrame, known: DataFrame) -> DataFrame:
    """The nodes needed (of a written table, rows may repeat) with their whole sets, as (node, shingles)."""
    these = F.broadcast(needed) if _fits(needed, 4) else needed.distinct()
    one = known.select("node", "doc_id").join(these, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("id_"))
    ids = _few(one.select("id_"), 1, "ids", needed)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), hashes) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(map(_node, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id_")), "left_semi").select("text")
    return texts.mapInArrow(shingles, "node binary, shingles binary").where("node IS NOT NULL").dropDuplicates(["node"])


def _linked(pairs: DataFrame, docs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of the pairs (u, v, n_u, n_v) that link, verified on the whole sets."""
    pairs = written(pairs, "pairs")
    sets = written(_sets(pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))), docs, known), "sets")
    pairs = _few(pairs.select("u", "v"), 6)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3))
            keep = pa.array([_links(*(np.frombuffer(x.as_py(), np.uint64) for x in pair)) for pair in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["u", "v"])

    one = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    both = one.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v").select("u", "v", "a", "b")
    return written(both.mapInArrow(verify, "u binary, v binary"), "links")


class _Sketches:
    """The sketches of a group, by size, to compare one with many."""

    def __init__(self, bits: list[bytes]):
        self.size = np.array([len(x) for x in bits])
        self.row = np.zeros(len(bits), np.int64)
        self.own: dict[int, np.ndarray] = {}
        for size in set(self.size.tolist()):
            at = np.flatnonzero(self.size == size)
            self.row[at] = np.arange(len(at))
            self.own[size] = np.frombuffer(b"".join(bits[i] for i in at.tolist()), np.uint64).reshape(len(at), -1)

    def differ_each(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Bits in which each of u differs from its v, whose sketches are of half to twice the size of its own."""
        out = np.zeros(len(u), np.int64)
        swap = self.size[u] > self.size[v]
        u, v = np.where(swap, v, u), np.where(swap, u, v)
        for size in np.unique(self.size[u]).tolist():
            for other in np.unique(self.size[v[self.size[u] == size]]).tolist():
                at = np.flatnonzero((self.size[u] == size) & (self.size[v] == other))
                step = max(1, PAIRS_AT_ONCE * SKETCH_BITS // 8 // other)
                for some in (at[k : k + step] for k in range(0, len(at), step)):
                    a, b = self.own[size][self.row[u[some]]], self.own[other][self.row[v[some]]]
                    b = _folded(b) if other > size else b
                    out[some] = np.bitwise_count(a ^ b).sum(axis=1)
        return out

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """Bits in which i differs from others, whose sketches are of half to twice the size of its own."""
        size, out = int(self.size[i]), np.zeros(len(others), np.int64)
        one = self.own[size][self.row[i]]
        for other in set(self.size[others].tolist()):
            at = np.flatnonzero(self.size[others] == other)
            many, single = self.own[other][self.row[others[at]]], one
            many = _folded(many) if other > size else many
            single = _folded(single) if other < size else single
            out[at] = np.bitwise_count(many ^ single).sum(axis=1)
        return out


def _forest(sketches: _Sketches, n: np.ndarray, root: np.ndarray, may: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """The pairs that join the components of a group by the nearest sketches, where such pairs may link.

    Components enter one after the other, each by its nearest member; memory is in
    proportion to the members. ``may`` counts the pairs of each member that may link.
    """
    _, label, sizes = np.unique(root, return_inverse=True, return_counts=True)
    far = np.iinfo(np.int64).max
    near, via = np.full(len(n), far), np.full(len(n), -1)
    out, left, entering = np.arange(len(n)), sizes.copy(), int(np.argmax(sizes))
    while True:
        own, out = out[label[out] == entering], out[label[out] != entering]
        left[entering] = 0
        if not len(out):
            return
        for i in own.tolist():
            rest = out[_may_link(n[i], n[out], 0)]
            differ = sketches.differ(i, rest)
            allowed = _may_link(n[i], n[rest], differ)
            if may is not None:
                may[i] += np.count_nonzero(allowed)
                may[rest[allowed]] += 1
            closer = allowed & (differ < near[rest])
            near[rest[closer]], via[rest[closer]] = differ[closer], i
        nearest = out[np.argmin(near[out])]
        if near[nearest] < far:
            yield int(via[nearest]), int(nearest)
            entering = int(label[nearest])
        else:  # nothing left may link with what has entered
            entering = int(np.argmax(left))


def _all_near(sketches: _Sketches, n: np.ndarray, root: np.ndarray, own: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a group (all, or the members ``own``) that are in different components and may link.

    Components may be joined, in ``root``, between one member and the next.
    """
    own = np.arange(len(n)) if own is None else own
    for at, i in enumerate(own.tolist()):
        rest = own[at + 1 :]
        rest = rest[(root[rest] != root[i]) & _may_link(n[i], n[rest], 0)]
        if len(rest):
            rest = rest[_may_link(n[i], n[rest], sketches.differ(i, rest))]
            yield np.full(len(rest), i), rest


def _candidates(sketches: _Sketches, number: np.ndarray, n: np.ndarray, root: np.ndarray, starts: np.ndarray, size: int):
    """The pairs of groups of one size that are in different components and may link, as (start of the group, pair).

    Rows have the members ``number``, whose sketches, sizes and components are given; a pair is
    the smaller number times the members, and the larger. One that many groups have is compared once per batch.
    """
    first, second = np.triu_indices(size, 1)
    step = max(1, PAIRS_AT_ONCE // len(first))
    for some in (starts[k : k + step] for k in range(0, len(starts), step)):
        u, v = (number[(some[:, None] + side).ravel()] for side in (first, second))
        may = np.flatnonzero((root[u] != root[v]) & _may_link(n[u], n[v], 0))
        u, v = u[may], v[may]
        pairs, which = np.unique(np.minimum(u, v) * len(n) + np.maximum(u, v), return_inverse=True)
        u, v = np.divmod(pairs, len(n))
        near = _may_link(n[u], n[v], sketches.differ_each(u, v))[which]
        yield some[may[near] // len(first)], pairs[which[near]]


def _spanning(u: np.ndarray, v: np.ndarray, differ: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Which of the pairs join the components that all of them join, the nearest first."""
    _, label = np.unique(root, return_inverse=True)
    above, chosen = list(range(len(label))), []

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    order = np.lexsort((v, u, differ))
    for at, a, b in zip(order.tolist(), label[u[order]].tolist(), label[v[order]].tolist()):
        a, b = top(a), top(b)
        if a != b:
            above[a] = b
            chosen.append(at)
    return np.array(chosen, np.int64)


def _compare(rows: pd.DataFrame, every: bool) -> pd.DataFrame:
    """Of the members of each signature, pairs in different components that may link: all, or a forest.

    All signatures have one forest together, or all the pairs found if these are no more than their
    members. With a forest also the members (``u``) of signatures (``open``) that have further such pairs.
    """
    sig, key = rows["sig"].to_numpy(), rows["key"].to_numpy()
    order = np.lexsort((key, sig))
    sig = sig[order]
    _, at, number = np.unique(key[order], return_index=True, return_inverse=True)
    node, bits, n, root = (rows[c].to_numpy()[order[at]] for c in ("node", "bits", "n", "root"))
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    sizes = np.diff(np.append(starts, len(sig)))
    sketches, none = _Sketches(bits.tolist()), np.zeros(0, np.int64)
    groups, codes, found, large = [none], [none], [none], []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL_GROUP)]).tolist():
        for group, pairs in _candidates(sketches, number, n, root, starts[sizes == size], size):
            groups.append(group)
            codes.append(pairs)
    groups, codes = np.concatenate(groups), np.concatenate(codes)
    for a, size in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
        own, may = number[a : a + size], np.zeros(size, np.int64)
        if every:
            near = _all_near(sketches, n, root, own)
        else:
            forest = _forest(_Sketches(bits[own].tolist()), n[own], root[own], may)
            near = [own[np.array(list(forest), np.int64).reshape(-1, 2).T]]
            large.append((a, own, may))
        for u, v in near:
            found.append(np.minimum(u, v) * len(n) + np.maximum(u, v))
    pairs = np.unique(np.concatenate([codes, *found]))
    u, v = np.divmod(pairs, max(1, len(n)))
    if not every and len(pairs) > len(n):
        chosen = np.sort(_spanning(u, v, sketches.differ_each(u, v), root))
        pairs, u, v = pairs[chosen], u[chosen], v[chosen]
    # (start of the signature, member) with a pair that is not given
    further = ~np.isin(codes, pairs)
    open_ = [np.stack([groups[further], side[further]]) for side in np.divmod(codes, max(1, len(n)))]
    for a, own, may in large:
        here = np.zeros(len(n), bool)
        here[own] = True
        given = here[u] & here[v] & (root[u] != root[v])
        left = own[may > np.bincount(np.concatenate([u[given], v[given]]), minlength=len(n))[own]]
        open_.append(np.stack([np.full(len(left), a), left]))
    swap = node[u] > node[v] if len(u) else np.zeros(0, bool)
    u, v = np.where(swap, v, u), np.where(swap, u, v)
    out = pd.DataFrame({"u": node[u], "v": node[v], "n_u": n[u], "n_v": n[v], "open": pd.array([None] * len(u), "Int64")})
    open_ = np.unique(np.concatenate(open_, axis=1), axis=1)
    if every or not open_.shape[1]:
        return out
    more = pd.DataFrame({"u": node[open_[1]], "v": None, "n_u": n[open_[1]], "n_v": 0, "open": pd.array(sig[open_[0]], "Int64")})
    return pd.concat([out, more.astype({"v": object})])


def _merged(found: pd.DataFrame) -> pd.DataFrame:
    """Open signatures of a task that share members as one, under the smallest of them.

    Each member comes once, unless the whole sets of what would be one are too much for a task.
    """
    more = found[found["open"].notna()]
    if not len(more):
        return found
    sigs, sig = np.unique(more["open"].to_numpy(np.int64), return_inverse=True)
    member, _ = pd.factorize(more["u"])
    at = np.unique(member, return_index=True)[1]
    first, above = sig[at], list(range(len(sigs)))
    size = (more["n_u"].to_numpy(np.int64)[at] * 8 + 256).tolist()
    of: list[set[int]] = [set() for _ in sigs]
    for a, x in zip(sig.tolist(), member.tolist()):
        of[a].add(x)
    held = [sum(size[x] for x in group) for group in of]

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for a, b in zip(sig.tolist(), first[member].tolist()):
        a, b = sorted((top(a), top(b)))
        if a == b:
            continue
        few, many = sorted((a, b), key=lambda x: len(of[x]))
        both = held[many] + sum(size[x] for x in of[few] if x not in of[many])
        if both <= MERGED_SET_BYTES:
            of[many] |= of[few]
            above[b], held[a], of[a], of[b] = a, both, of[many], set()
    least = sigs[[top(x) for x in sig.tolist()]]
    more = more.assign(open=pd.array(least, "Int64")).drop_duplicates(["u", "open"])
    return pd.concat([found[found["open"].isna()], more])


def _joining(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the members of each signature (sig, root, node, shingles), links that join what all their links join."""
    rows = rows.sort_values(["sig", "node"])
    sig = rows["sig"].to_numpy()
    number, node = pd.factorize(rows["node"])
    _, at = np.unique(number, return_index=True)
    root, sets = rows["root"].to_numpy()[at], [np.frombuffer(x, np.uint64) for x in rows["shingles"].iloc[at]]
    n, sketches = np.array([len(x) for x in sets]), _Sketches([_sketch(x) for x in sets])
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    sizes = np.diff(np.append(starts, len(sig)))

    def near() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL_GROUP)]).tolist():
            for _, pairs in _candidates(sketches, number, n, root, starts[sizes == size], size):
                yield np.divmod(np.unique(pairs), len(n))
        for a, size in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
            yield from _all_near(sketches, n, root, np.sort(number[a : a + size]))

    found, apart = [], set()
    for us, vs in near():
        for u, v in zip(us.tolist(), vs.tolist()):
            if root[u] == root[v] or (u, v) in apart:
                continue
            if _links(sets[u], sets[v]):
                root[root == root[v]] = root[u]
                found.append((u, v))
            elif len(apart) < KEPT_PAIRS:
                apart.add((u, v))
    u, v = np.array(found, np.int64).reshape(-1, 2).T
    return pd.DataFrame({"u": node.to_numpy()[u], "v": node.to_numpy()[v]})


def _with_sketches(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of keys (key, other) with the nodes, sizes and sketches of both."""
    for key, side in (("key", "a"), ("other", "b")):
        of = known.select(F.col("key").alias(key), *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "bits")])
        pairs = pairs.join(of, key)
    return pairs


def _apart(members: DataFrame, known: DataFrame, roots: DataFrame, every: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs that share a signature, are in different components and may link, as (u, v, n_u, n_v): all, or a forest.

    Also the members that have further such pairs, as (sig, node, n); signatures of a task that share members are one.
    """
    of = known.select("key", "node").join(_few(roots, 6), "node", "left")
    of = _few(written(of.select("key", F.xxhash64(F.coalesce("root", "node")).alias("root")), "of"), 2)
    members = members.select("sig", "key")
    groups = members.join(of, "key").groupBy("sig").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("size"),
        F.min("key").alias("key"), F.max("key").alias("other"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(2), "key")).alias("x2"),
    ).where("least <> most")
    groups = written(groups, "groups")
    two = _near(_with_sketches(groups.where("size = 2").select("key", "other").repartition("key").distinct(), known))
    # Signatures with the same members are compared once.
    large = groups.where("size > 2")
    more = large.groupBy("size", "key", "other", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig")
    apart = written(members.join(_few(more, 1, "more", large), "sig").join(of, "key"), "apart")
    parts = -(-apart.count() // MEMBERS_PER_PART)
    together = apart.join(known.select("key", "node", "n", "bits"), "key")
    together = together.withColumn("part", F.pmod(F.xxhash64("sig"), F.lit(max(1, parts))))
    found = together.select("part", "sig", "key", "root", "node", "n", "bits").groupBy("part").applyInPandas(
        lambda rows: _merged(_compare(rows, every)), "u binary, v binary, n_u long, n_v long, open long"
    )
    found = written(found, "found")
    pairs = two.union(found.where("open IS NULL").select("u", "v", "n_u", "n_v")).dropDuplicates(["u", "v"])
    return pairs, found.where("open IS NOT NULL").select(F.col("open").alias("sig"), F.col("u").alias("node"), F.col("n_u").alias("n"))


def _further(members: DataFrame, docs: DataFrame, known: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (u, v) that join the components which the members (sig, node, n) of a signature link, verified where they meet."""
    of = members.join(_few(roots, 6), "node", "left").withColumn("root", F.xxhash64(F.coalesce("root", "node")))
    groups = of.groupBy("sig").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(2), "node")).alias("x2"),
    ).where("least <> most")
    once = groups.groupBy("size", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig")
    apart = written(of.join(_few(once, 1, "more", members), "sig"), "apart")
    parts = -(-(apart.agg(F.sum(F.col("n") * 8 + 256)).first()[0] or 0) // SET_BYTES_PER_PART)
    together = apart.join(_sets(apart.select("node"), docs, known), "node")
    together = together.withColumn("part", F.pmod(F.xxhash64("sig"), F.lit(max(1, parts))))
    return written(together.select("part", "sig", "root", "node", "shingles").groupBy("part").applyInPandas(_joining, "u binary, v binary"), "links")


def link_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    every = _index(docs, int(max(1, -(-chars // CHARS_PER_PART))))
    index, rows = every.where("sig IS NOT NULL"), every.where("sig IS NULL").select("key", "doc_id", "n", "node", "bits")
    known = rows.where("node IS NOT NULL")

    # Equal sets that were indexed by several tasks share all signatures: the first one stands for them.
    twins = known.groupBy("node").agg(F.count("*").alias("copies"), F.min("key").alias("least")).where("copies > 1")
    twins = written(known.join(twins, "node").where("key <> least").select("key"), "twins")  # used more than once
    members = index.join(F.broadcast(twins), "key", "left_anti") if _fits(twins, 1) else written(index.join(twins, "key", "left_anti"), "members")

    best = F.max(F.struct("shared", "other"))["other"].alias("other")
    pairs = members.where("key <> first").groupBy("key", F.col("first").alias("other")).agg(F.count("*").alias("shared"))
    compared = written(_near(_with_sketches(pairs.groupBy("key").agg(best), known)), "near")
    roots = components(_linked(compared, docs, known))

    def joined(fresh: DataFrame) -> DataFrame:
        if fresh.isEmpty():
            return roots
        # Only what is joined already is linked: few nodes and rounds, however many members these have.
        rooted = _few(roots, 6)
        ends = fresh
        for end in ("u", "v"):
            of = rooted.select(F.col("node").alias(end), "root")
            ends = ends.join(of, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        above = _few(components(ends), 6)
        old = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        new = above.join(rooted.select("node"), "node", "left_anti").select("node", "root")
        return written(old.select("node", F.coalesce("top", "root").alias("root")).union(new), "roots")

    left, further = _apart(members, known, roots, False)
    left = written(left.join(_few(compared.select("u", "v"), 6), ["u", "v"], "left_anti"), "left")
    if not left.isEmpty():
        roots = joined(_linked(left, docs, known))
    if not further.isEmpty():
        roots = joined(_further(further, docs, known, roots))

    rooted = rows.join(_few(roots, 6), "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rooted.join(_few(smallest, 4, "smallest", rows.select("key")), "root", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose identifier is the smallest of its component, with their own columns.

    Rows that repeat a staying identifier stay too; so do rows without words or identifier.
    """
    groups = link_groups(docs, id_col, text_col)
    name = unused("stays_", docs.columns)
    stays = written(groups.where("doc_id <=> component_id").select(F.col("doc_id").alias(name)).distinct(), "stays")
    stays = F.broadcast(stays) if stays.count() <= BROADCAST_IDS else stays
    return docs.join(stays, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(name)), "left_semi")
