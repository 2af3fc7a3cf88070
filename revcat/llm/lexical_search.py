"""Ranked lexical search, term at a time, with a limit on accumulators.

Documents are indexed in blocks of bounded size: a map task counts, per document,
the terms that any query has, and lays the block's postings out by term. How many
documents hold a term follows from the postings. Then every block answers every
query: terms are taken rarest first, each adding to the accumulators of its
documents. Once the most that the remaining terms can add is below the kth best
score, final in earlier blocks of the task or partial in this one, no accumulator
is created any more, but those there are go on to their exact scores. The best k of
all tasks meet in one ranking.

Blocks only ever emit their best k per query, so no shuffle grows with the
postings. Queries go to the tasks in groups of bounded terms, one pass over the
documents per group.

Null text has no terms. A document without terms is never found and not counted. A
query without terms finds nothing. Of equal scores the smaller identifier ranks
first, null last; rows that repeat an identifier are ranked each on its own, and
so are queries. Other columns are not read, so they may have any name. An empty
table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revcat.llm.common import UPPER, fold, small_batches, whole_text
from revcat.llm.term_matrix import pieces
from revcat.session import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A block is closed beyond so many bytes of text or so many documents.
BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 1 << 15
#: Terms of queries, repeats included, that are sent to the tasks at once.
GROUP_TERMS = 200_000

#: ASCII but digits and letters becomes a space, A-Z lower case.
_TERMS_ONLY = bytes(
    c + 32 if chr(c) in UPPER else c if c > 127 or chr(c).isalnum() else 32 for c in range(256)
)

INDEX = "ids array<long>, sizes array<int>, terms array<int>, starts array<int>, docs array<int>, times array<int>"


@dataclass(frozen=True)
class Queries:
    """A group of queries: ``terms[starts[q]:starts[q + 1]]`` are those of query q, rarest first."""

    keys: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray  # times repeats


def _list(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per block of documents (doc_id, text): identifiers, sizes in terms, and postings by term.

    ``docs[starts[i]:starts[i + 1]]`` are the places of the documents that hold
    ``terms[i]``, and ``times`` how often they do.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, found, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            term, times = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in (0, 1))
            doc = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
            order = np.argsort(term, kind="stable")
            term, doc, times = term[order], doc[order], times[order]
            starts = np.flatnonzero(np.diff(term, prepend=-1))
            columns = [
                _list(ids, pa.int64()), _list(sizes, pa.int32()), _list(term[starts], pa.int32()),
                _list(np.append(starts, len(term)), pa.int32()), _list(doc, pa.int32()), _list(times, pa.int32()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["ids", "sizes", "terms", "starts", "docs", "times"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw, own, n = text.as_py().encode().translate(_TERMS_ONLY), [], 0
                for part in pieces(raw):
                    words = part.split()
                    n += len(words)
                    own.append(np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words)))
                own = np.concatenate(own)
                if not n:
                    continue
                ids.append(name)
                sizes.append(n)
                found.append(np.unique(own[own >= 0], return_counts=True))
                size += len(raw)
                if size >= BLOCK_BYTES or len(ids) == BLOCK_DOCS:
                    yield out()
                    ids, sizes, found, size = [], [], [], 0
        if ids:
            yield out()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(count, INDEX)


class _Best:
    """The best k of a query so far, in order."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.no_id, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def limit(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, no_id: np.ndarray, id_: np.ndarray) -> None:
        score, no_id, id_ = (np.concatenate(p) for p in ((self.score, score), (self.no_id, no_id), (self.id, id_)))
        order = np.lexsort((id_, no_id, -score))[: self.k]
        self.score, self.no_id, self.id = score[order], no_id[order], id_[order]


def accumulate(terms: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, k: int, limit: int) -> np.ndarray:
    """Scores of a block's documents: exact for all that can be among the best k, of others 0 or less than that.

    ``terms`` are (most it can add, documents, what it adds), rarest first;
    ``limit`` is a score that k other documents reach.
    """
    scores = np.zeros(n_docs, np.int64)
    remaining = sum(most for most, _, _ in terms)
    creating = True
    for most, docs, adds in terms:
        # Equal to the limit may still win by its identifier.
        creating = creating and remaining >= limit
        if creating:
            scores[docs] += adds
        else:
            there = scores[docs] > 0
            scores[docs[there]] += adds[there]
        remaining -= most
        if creating and remaining < scores.max(initial=0):
            started = scores[scores > 0]
            if len(started) >= k:
                limit = max(limit, int(np.partition(started, len(started) - k)[len(started) - k]))
    return scores


def _answers(indexed: DataFrame, queries: Queries, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(key, doc_id, score): the best k of every query in each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [None] * len(queries.keys)
        for batch in batches:
            for at in range(batch.num_rows):
                ids, sizes, terms, starts, docs, times = (batch[c][at].values for c in range(6))
                no_id, ids = ids.is_null().to_numpy(False), ids.fill_null(0).to_numpy()
                sizes, terms, starts, docs, times = (c.to_numpy().astype(np.int64) for c in (sizes, terms, starts, docs, times))
                m = 100 - 75 + 75 * sizes * n_docs // n_terms
                impact = 1_000_000_000 * times // (1000 * times + 8 * m[docs])
                most = np.maximum.reduceat(impact, starts[:-1]) if len(terms) else np.zeros(0, np.int64)
                place = np.full(int(queries.terms.max(initial=0)) + 1, -1)
                place[terms] = np.arange(len(terms))
                for q, (a, b) in enumerate(zip(queries.starts[:-1].tolist(), queries.starts[1:].tolist())):
                    held = place[queries.terms[a:b]]
                    own = [
                        (w * int(most[p]), docs[starts[p] : starts[p + 1]], w * impact[starts[p] : starts[p + 1]])
                        for p, w in zip(held.tolist(), queries.weights[a:b].tolist())
                        if p >= 0 and w > 0
                    ]
                    if not own:
                        continue
                    best[q] = best[q] or _Best(k)
                    limit = best[q].limit()
                    if sum(most_ for most_, _, _ in own) < limit:
                        continue
                    scores = accumulate(own, len(ids), k, limit)
                    found = np.flatnonzero(scores >= max(1, limit))
                    if len(found) > k:
                        kth = np.partition(scores[found], len(found) - k)[len(found) - k]
                        found = found[scores[found] >= kth]
                    best[q].add(scores[found], no_id[found], ids[found])
        for q, one in enumerate(best):
            if one is not None and len(one.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(one.score), queries.keys[q])), pa.array(one.id, mask=one.no_id), pa.array(one.score),
                ], ["key", "doc_id", "score"])

    return indexed.mapInArrow(search, "key long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Each item's k highest-scoring documents with a score above 0: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), whole_text(f"`{item_text_col}`").alias("text"))
    asked = written(asked.withColumn("key", F.monotonically_increasing_id()), "items")
    terms = asked.select("key", F.explode(F.regexp_extract_all(fold(F.col("text")), F.lit(f"({TERM})"), F.lit(1))).alias("term"))
    terms = written(terms.groupBy("key", "term").agg(F.count("*").alias("repeats")), "terms")
    groups = -(-(terms.agg(F.sum("repeats")).first()[0] or 0) // GROUP_TERMS)
    found = [_search_group(docs, terms.where(F.pmod(F.xxhash64("key"), F.lit(groups)) == g), k) for g in range(groups)]
    if not found:
        found = [spark.createDataFrame([], "key long, doc_id long, score long")]
    ranked = reduce(DataFrame.union, found).withColumn(
        "rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    )
    return ranked.where(F.col("rank") <= k).join(asked.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


def _search_group(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """Answers to queries of bounded terms: what is collected here is the queries and a count per term of theirs."""
    asked = terms.toPandas()
    words = sorted(set(asked["term"]))
    number = {word: i for i, word in enumerate(words)}
    indexed = written(index(docs, {word.encode(): i for word, i in number.items()}), "index")
    n_docs, n_terms = indexed.agg(
        F.coalesce(F.sum(F.size("ids")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x)), F.lit(0)),
    ).first()
    held = F.transform("terms", lambda term, i: F.struct(term.alias("term"), (F.get("starts", i + 1) - F.get("starts", i)).cast("long").alias("n")))
    holders = np.zeros(len(words), np.int64)
    for row in indexed.select(F.inline(held)).groupBy("term").agg(F.sum("n").alias("n")).collect():
        holders[row["term"]] = row["n"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in holders.tolist()], np.int64)
    term = asked["term"].map(number).to_numpy(np.int64)
    key = asked["key"].to_numpy(np.int64)
    order = np.lexsort((term, holders[term], key))
    key, term, repeats = key[order], term[order], asked["repeats"].to_numpy(np.int64)[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    queries = Queries(key[starts], np.append(starts, len(key)), term, weight[term] * repeats)
    return _answers(indexed, queries, n_docs, n_terms, k)
