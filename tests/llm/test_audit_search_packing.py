"""Filter audit, lexical search and packing: awkward rows against SQL in another engine, brute force and round trips."""

import collections
import random
import zlib
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revcat.llm import filter_audit, lexical_search, packing, term_matrix
from revcat.llm.queries import ORACLES, QUERIES
from revcat.session import written

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, `row` string, `a.b` string, part string, id string, mask int, block int, key int"


def corpus():
    r = random.Random(11)
    words = ["".join(r.choice("abcÉßAB1") for _ in range(r.randint(1, 5))) for _ in range(120)]

    def text(n, sep=" "):
        return sep.join(r.choice(words) for _ in range(n))

    texts = [text(r.choice([1, 4, 49, 50, 51, 60, 200]), r.choice([" ", "\n", "  ", "-"])) for _ in range(80)]
    texts += [t + r.choice(["#", " $x", "|", ""]) for t in texts[:30]] + texts[:25]
    texts += [t.lower() for t in texts[:40]] + [None, "", "", " \n\t\x0b ", "z" * 3000, text(40_000), "Σίσυφος ΣΑΣ é ́x   it's 12%"]
    rows = [(i, t, r.choice(["a", "b", "", None])) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (3, "another text under the same number", "a"), (None, texts[5], "b"), (None, texts[5], None), (None, None, None)]
    return [(*row, "r", "d", "p", "i", 1, 2, 3) for row in rows]


def labelled():
    r = random.Random(2)
    rows = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 150, 2)]
    return [*rows, (2, 1, 1), (None, 1, 1), (9999, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(5).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(labelled(), "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    r = random.Random(4)
    texts = [row[1] for row in corpus() if row[1]]
    asked = [(i, " ".join(r.choice(texts).split()[: r.randint(1, 20)])) for i in range(30)]
    asked += [(30, None), (31, ""), (32, "--- !!"), (33, "nowhereword"), (0, asked[0][1]), (None, "A b C"), (34, texts[-7])]
    return spark.createDataFrame([(*row, "x") for row in asked], "item_id long, text string, rank string")


@pytest.fixture(scope="module")
def duck(docs, labels, items):
    connection = duckdb.connect()
    connection.register("documents_", docs.select("doc_id", "text", "source").toArrow())
    connection.register("labels_", labels.toArrow())
    connection.register("benchmark_", items.select("item_id", "text").toArrow())
    for name in ("documents", "labels", "benchmark"):
        connection.sql(f"CREATE TABLE {name} AS SELECT * FROM {name}_")
    return connection


def same(frame, expected):
    order = sorted(range(len(expected.columns)), key=lambda i: expected.columns[i])
    rows = collections.Counter(repr([r[c] for c in sorted(frame.columns)]) for r in frame.collect())
    assert rows == collections.Counter(repr([r[i] for i in order]) for r in expected.fetchall())


@pytest.fixture(params=[1 << 30, 3000])
def small_blocks(request, monkeypatch):
    """Blocks of any size give the same results."""
    monkeypatch.setattr(term_matrix, "BLOCK_BYTES", request.param)
    monkeypatch.setattr(term_matrix, "WORDS_PER_PART", request.param)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", request.param)


def test_matrix_holds_every_count(docs, small_blocks):
    dictionary, shards = term_matrix.matrix(docs.drop("a.b"))
    named = dictionary.collect()
    words = {r["term"]: r["word"] for r in named}
    assert len(named) == len(words) == len(set(words.values()))
    found = collections.Counter()
    for shard in shards.collect():
        assert shard["indptr"][-1] == len(shard["indices"]) == len(shard["counts"])
        for row, a, b in zip(shard["rows"], shard["indptr"], shard["indptr"][1:]):
            terms = shard["indices"][a:b]
            assert terms == sorted(set(terms))
            found[row["doc_id"], row["block"], frozenset((words[t], n) for t, n in zip(terms, shard["counts"][a:b]))] += 1
    brute = collections.Counter(
        (doc, 2, frozenset((w.decode(), n) for w, n in collections.Counter((text or "").encode().split()).items())) for doc, text, *_ in corpus()
    )
    assert found == brute


def test_matrix_holds_every_count_in_rows_of_any_size(docs, small_blocks, monkeypatch):
    monkeypatch.setattr(term_matrix, "ROW_BYTES", 300)
    test_matrix_holds_every_count(docs, small_blocks)


def test_matrix_rows_and_row_groups_stay_small(spark, monkeypatch):
    """A block of 360,000 entries and 60,000 words leaves its task in rows of a megabyte, and no file holds them as one."""
    stored = []
    monkeypatch.setattr(term_matrix, "written", lambda *a: stored.append(written(*a)) or stored[-1])
    monkeypatch.setattr(term_matrix, "STORED", getattr(term_matrix, "STORED", {}) | {"parquet.block.size": "65536"}, raising=False)
    words = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.concat(F.lit("a" * 25), ((F.col("id") * 60 + i) % 60_000).cast("string")))
    _, shards = term_matrix.matrix(spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text")))
    width = F.greatest(F.size("indices") * 8, F.coalesce(F.length("words"), F.lit(0)))
    assert stored[0].agg(F.max(width)).first()[0] < 1.1 * 2**20
    assert shards.agg(F.sum(F.size("rows")), F.sum(F.size("indices")), F.max(F.size("indices")) < 150_000).first() == (6000, 360_000, True)
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in stored[0].inputFiles()]
    assert max(groups) >= 4


def test_pieces_cut_at_white_space_only():
    text = b"ab  cd\ne" * 50 + b"x" * 300 + b" y"
    for size in (1, 7, 64, 10_000):
        parts = list(term_matrix.pieces(text, size))
        assert [w for p in parts for w in p.split()] == text.split()


def test_audit_as_sql(docs, labels, duck, small_blocks):
    same(filter_audit.audit(filter_audit.masks(docs, labels)), duck.sql(ORACLES["op11_filter_audit"]))


def test_audit_of_any_masks(spark):
    """Applying the filters one by one, document by document."""
    r, filters = random.Random(1), "ABCD"
    rows = [(r.choice("xy"), r.randrange(16), r.randint(1, 4), 0, r.randint(0, 1)) for _ in range(25)]
    counted = spark.createDataFrame(rows, "part string, mask int, docs long, good long, toxic long")
    expected = {}
    for part in "xy":
        for order in permutations(filters):
            left = [(mask, docs) for p, mask, docs, *_ in rows if p == part]
            for step, letter in enumerate(order, 1):
                bit = 1 << filters.index(letter)
                removed = sum(n for mask, n in left if mask & bit)
                left = [(mask, n) for mask, n in left if not mask & bit]
                expected[part, "".join(order), step] = (removed, sum(n for _, n in left))
    total = collections.Counter()
    for (part, order, step), (removed, _) in expected.items():
        total[part, order[step - 1]] += removed
    found = filter_audit.audit(counted, filters).collect()
    assert {(r["part"], r["filter_order"], r["step"]): (r["removed"], r["kept"]) for r in found} == expected
    assert all(r["shapley"] == total[r["part"], r["filter_order"][r["step"] - 1]] for r in found)


def test_search_as_sql(docs, items, duck, small_blocks):
    same(lexical_search.search(docs, items), duck.sql(ORACLES["op12_lexical_search"]))


def test_search_in_groups_of_queries(docs, items, duck, monkeypatch):
    monkeypatch.setattr(lexical_search, "GROUP_TERMS", 15_000)
    same(lexical_search.search(docs, items), duck.sql(ORACLES["op12_lexical_search"]))


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_limited_accumulators_keep_the_best(data):
    n_docs, k = data.draw(st.integers(1, 30)), data.draw(st.integers(1, 5))
    terms = []
    for _ in range(data.draw(st.integers(0, 6))):
        held = sorted(data.draw(st.sets(st.integers(0, n_docs - 1), min_size=1)))
        adds = np.array([data.draw(st.integers(0, 9)) for _ in held], np.int64)
        terms.append((int(adds.max()), np.array(held), adds))
    exact = np.zeros(n_docs, np.int64)
    for _, held, adds in terms:
        exact[held] += adds
    limit = data.draw(st.integers(0, 20))
    scores = lexical_search.accumulate(terms, n_docs, k, limit)
    kth = max(limit, int(np.sort(exact)[-k]) if n_docs >= k else 0)
    for score, right in zip(scores, exact):
        assert score == right if right >= max(1, kth) else score <= right


def test_accumulators_are_limited():
    """A word that all documents hold makes none of them a candidate once rarer words have found enough."""
    rare = (1000, np.arange(10), np.full(10, 1000))
    common = (1, np.arange(5000), np.ones(5000, np.int64))
    assert np.count_nonzero(lexical_search.accumulate([rare, common], 5000, 10, 0)) == 10
    assert np.count_nonzero(lexical_search.accumulate([rare, common], 5000, 11, 0)) == 5000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_pack_fills_every_sequence(lengths):
    capacity = 32
    packed = packing.pack(lengths, capacity)
    seen, ends = collections.defaultdict(list), collections.Counter()
    for sequence, offset, document, start, length in packed:
        assert offset == ends[sequence] and length > 0
        ends[sequence] += length
        seen[document].append((start, length))
    assert sorted(ends.values(), reverse=True) == packing.room(sum(lengths), capacity).tolist()
    assert all(n == capacity or n & (n - 1) == 0 for n in ends.values()) and sum(n < capacity for n in ends.values()) <= 5
    for document, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[document]):
            assert start == at
            at += n
        assert at == length


def test_pack_balances_cost():
    r = random.Random(8)
    lengths = [r.choice([20, 60, 300, 900, 1500]) for _ in range(4000)]

    def spread(pieces):
        cost = collections.Counter()
        for sequence, *_, length in pieces:
            cost[sequence] += length + length * length / 500
        full = [c for s, c in cost.items() if s < sum(lengths) // 2048]
        return np.std(full) / np.mean(full)

    def in_order():
        at = 0
        for document, length in enumerate(lengths):
            while length:
                taken = min(length, 2048 - at % 2048)
                yield at // 2048, at % 2048, document, 0, taken
                at, length = at + taken, length - taken

    balanced = packing.pack(lengths, 2048, 1, 1 / 500)
    assert spread(balanced) < 0.7 * spread(in_order())
    cut = len(balanced) - len(lengths)
    assert cut < len(list(in_order())) - len(lengths)


@pytest.mark.parametrize("sequences", [1, packing.BLOCK_SEQUENCES])
def test_packing_round_trip(docs, sequences, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_SEQUENCES", sequences)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = collections.Counter()
    for doc, text, *_ in corpus():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        expected[doc, np.array(ids, "<u4").tobytes()] += 1
    packed = packing.pack_documents(docs, VOCABULARY)
    rows = packed.collect()
    by_sequence = collections.defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        assert len(row["ids"]) == 4 * row["length"]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    whole = collections.Counter(doc for doc, *_ in corpus())
    once = {doc for doc, n in whole.items() if n == 1}
    found = collections.Counter()
    for doc in once:
        found[doc, b"".join(bytes(r["ids"]) for r in sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"]))] += 1
    assert found == collections.Counter({k: n for k, n in expected.items() if k[0] in once})
    assert sum(r["length"] for r in rows) == sum(n * len(ids) // 4 for (_, ids), n in expected.items())
    joined = packing.sequences(packed).collect()
    assert {r["sequence_id"]: len(r["ids"]) // 4 for r in joined} == {s: sum(n for _, n in p) for s, p in by_sequence.items()}


def test_words_are_encoded_as_whole_texts():
    tokenizer, encoder = Tokenizer.from_file(VOCABULARY), packing.encoder(open(VOCABULARY).read())
    tokenizer.encode_special_tokens = True
    r = random.Random(6)
    parts = [" ", "\n", "\t", "\x0b", " ", "́", "ͅ", "Σ", "σ", "A", "é", "é", "İ", "ß", "'s", "'LL", "1", "²", "中", "#", "\x1c", "\x85", "👍🏽", "‍", "가", "ᆨ", "'", "re", "<|endoftext|>", "\x00", "\x7f", "Ÿ", "ſ", "Ž", "ŉ", "×", "÷", "Ð", "ı", "z", "—"]
    parts += [chr(c) for c in range(1, 0x250)]
    for _ in range(6000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_store_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    encoder = packing.WordEncoder(open(VOCABULARY).read())
    for i in range(200):
        encoder.ids(f"word{i} and some more")
        assert encoder.held < 200


def test_empty_tables(spark, docs, labels, items):
    none = docs.limit(0)
    assert filter_audit.audit(filter_audit.masks(none, labels)).count() == 0
    assert filter_audit.audit(filter_audit.masks(docs, labels.limit(0))).count() == 120 * 5 * 3
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert packing.pack_documents(none, VOCABULARY).count() == 0


def test_packing_query(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_packing"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
        own = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(own)
