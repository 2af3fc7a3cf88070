"""Each operator against a brute-force version, on rows with nulls, empty texts, ties, repeats and extra columns."""

import base64
import collections
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from revcat.llm import bpe, exact_dedup, html_text, jaccard, mixing, quality_rules, quotations, repeated_bytes, toxicity, url_filter
from revcat.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, source string, id string, kept string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def corpus(seed=3, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeÉß") for _ in range(r.randint(1, 6))) for _ in range(80)]

    def text(k):
        return " ".join(r.choice(words) for _ in range(k))

    texts = [text(r.choice([1, 3, 5, 30, 90])) for _ in range(n)]
    for i in range(n // 2):
        near = texts[i].split(" ")
        near[r.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [texts[4], texts[4].upper(), "", None, " \n\t ", text(3000), "x" * 700, texts[7] + "\n" + texts[7]]
    rows = [(i, t, r.choice(["a", "b", "Z", None]), "e", "e") for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, texts[5], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(docs):
    groups = collections.defaultdict(list)
    for doc, text, *_ in corpus():
        groups[(text or "").translate(FOLD)].append(doc)
    expected = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).digest()
        expected.update((i, keep, len(ids), digest) for i in ids)
    rows = exact_dedup.duplicate_groups(docs).collect()
    assert collections.Counter((r["id"], r["keep_id"], r["group_size"], bytes(r["digest"])) for r in rows) == expected
    assert sum(r["kept"] for r in rows) == len(groups)
    assert all(r["id"] == r["keep_id"] for r in rows if r["kept"])


def test_exact_dedup_keeps_columns(docs):
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    texts = [(r["text"] or "").translate(FOLD) for r in kept.collect()]
    assert sorted(texts) == sorted({(t or "").translate(FOLD) for _, t, *_ in corpus()})


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def test_jaccard_groups(docs):
    rows = corpus()
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if sets[i] and doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    expected = collections.Counter((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, *_) in enumerate(rows))
    assert collections.Counter(map(tuple, jaccard.link_groups(docs).collect())) == expected


def grouped(rows):
    """Brute force: doc to the smallest doc reachable by links."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}


@pytest.mark.parametrize("centre", ["first", "last", "absent"])
@pytest.mark.parametrize("changes", [1, 2, 3])
def test_jaccard_ball_of_near_copies(spark, monkeypatch, centre, changes):
    """Each text a few words from one text: the work and the links must not hang on that text being there."""
    r = random.Random(changes)
    base = [f"w{r.randrange(10_000)}" for _ in range(150)]
    texts = []
    for _ in range(90):
        words = list(base)
        for at in r.sample(range(150), changes):
            words[at] = f"x{r.randrange(10_000)}"
        texts.append(" ".join(words))
    texts = {"first": [" ".join(base), *texts], "last": [*texts, " ".join(base)], "absent": texts}[centre]
    rows = list(enumerate(texts))
    emitted, linked = [], jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda pairs, *rest: (emitted.append(pairs.count()), linked(pairs, *rest))[1])
    found = jaccard.link_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {x["doc_id"]: x["component_id"] for x in found} == grouped(rows)
    if changes < 3:  # all of one component: a forest is enough
        assert sum(emitted) < 6 * len(rows)


def test_jaccard_ball_of_texts_that_just_fail_to_link(spark, monkeypatch):
    """Most pairs look near by their sketches and few link: the rows made must not grow with the pairs."""
    r = random.Random(4)
    base, rows = [f"w{r.randrange(10**6)}" for _ in range(1000)], []
    for doc in range(80):
        words = list(base)
        for at in r.sample(range(200), 17):
            words[5 * at + 2] = f"x{r.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    made, written = collections.Counter(), jaccard.written

    def counted(frame, name):
        kept = written(frame, name)
        made[name] += kept.count()
        return kept

    monkeypatch.setattr(jaccard, "written", counted)
    found = jaccard.link_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {x["doc_id"]: x["component_id"] for x in found} == grouped(rows)
    assert made["found"] <= 4 * len(rows) and made["left"] <= 2 * len(rows) and made["links"] <= 2 * len(rows)


def test_forest_joins_what_all_pairs_join():
    r = np.random.default_rng(5)
    for _ in range(60):
        m = int(r.integers(2, 25))
        sets = [np.unique(r.integers(0, 40, int(r.integers(8, 20))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(m)]
        sketches, n = jaccard._Sketches([jaccard._sketch(s) for s in sets]), np.array([len(s) for s in sets])
        root = r.integers(0, m, m)
        pairs = [(int(u), int(v)) for us, vs in jaccard._all_near(sketches, n, root) for u, v in zip(us, vs)]
        forest = list(jaccard._forest(sketches, n, root))
        assert {tuple(sorted(p)) for p in forest} <= set(pairs)

        def closed(edges):
            label = {x: x for x in range(m)} | {}
            for u, v in [*edges, *((i, j) for i in range(m) for j in range(i) if root[i] == root[j])]:
                a, b = label[u], label[v]
                label = {x: (a if y == b else y) for x, y in label.items()}
            return label

        assert {frozenset(x for x in range(m) if c[x] == y) for c in (closed(forest),) for y in c.values()} == {
            frozenset(x for x in range(m) if c[x] == y) for c in (closed(pairs),) for y in c.values()
        }
        assert len(forest) < len(np.unique(root))


def test_digests_take_one_worker_per_task(docs):
    """Ids are decoded where they are put together: a second worker in the task would hold as much again."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    digests = bpe.encoded_digests(docs.sparkSession, docs, vocabulary, public_tokenizers.PATTERN)
    plan = digests._jdf.queryExecution().sparkPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "InArrow" not in plan[: plan.index("FlatMapCoGroupsInPandas")]
    coded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    apart = bpe.decode(coded, vocabulary).collect()
    together = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded=True).collect()
    assert collections.Counter(map(tuple, together)) == collections.Counter(map(tuple, apart))


def member_rows(r, groups, members, size):
    """Rows of signatures as _compare gets them, and what all their pairs are."""
    base = np.unique(r.integers(0, 2**63, 40, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[: int(r.integers(25, 41))], r.integers(0, 2**63, int(r.integers(0, 9)), dtype=np.uint64)])) for _ in range(members)]
    root = r.integers(0, members // 3 + 1, members)
    rows = [
        {"part": 0, "sig": g, "key": int(k), "root": int(root[k]), "node": jaccard._node(sets[k]), "n": len(sets[k]), "bits": jaccard._sketch(sets[k])}
        for g in range(groups) for k in r.choice(members, int(r.integers(2, size + 1)), replace=False)
    ]
    rows = pd.DataFrame(rows)
    pairs = {}
    for g, own in rows.groupby("sig"):
        own, pairs[g] = own.sort_values("key"), set()
        for us, vs in jaccard._all_near(jaccard._Sketches(own["bits"].tolist()), own["n"].to_numpy(), own["root"].to_numpy()):
            pairs[g] |= {tuple(sorted((own["node"].iloc[u], own["node"].iloc[v]))) for u, v in zip(us, vs)}
    return rows, pairs


@pytest.mark.parametrize("small", [128, 4])
def test_compared_signatures(monkeypatch, small):
    """All pairs, or some that join as much; a signature is open if it has a pair that was not given."""
    monkeypatch.setattr(jaccard, "SMALL_GROUP", small)
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", 50)
    r = np.random.default_rng(3)
    for _ in range(25):
        rows, pairs = member_rows(r, int(r.integers(1, 12)), int(r.integers(9, 40)), int(r.integers(2, 9)))
        found = jaccard._compare(rows.sample(frac=1, random_state=1), True)
        assert set(zip(found["u"], found["v"])) == set().union(*pairs.values()) and found["open"].isna().all()
        found = jaccard._compare(rows.sample(frac=1, random_state=2), False)
        some = found[found["open"].isna()]
        given, open_ = set(zip(some["u"], some["v"])), set(found["open"].dropna())
        assert given <= set().union(*pairs.values()) and {g for g in pairs if pairs[g] - given} <= open_
        assert all(pairs[g] for g in open_)
        root = dict(zip(rows["node"], rows["root"]))

        def joined(edges):
            label = {x: x for x in root.values()}
            for u, v in edges:
                a, b = label[root[u]], label[root[v]]
                label = {x: (a if y == b else y) for x, y in label.items()}
            return {frozenset(x for x in label if label[x] == y) for y in label.values()}

        assert joined(given) == joined(set().union(*pairs.values()))


def test_small_signatures_are_compared_together(monkeypatch):
    """Not member by member, and no signature is left open that has no pair to give."""
    rows, pairs = member_rows(np.random.default_rng(4), 300, 200, 8)
    calls, differ = [], jaccard._Sketches.differ
    monkeypatch.setattr(jaccard._Sketches, "differ", lambda self, *args: (calls.append(1), differ(self, *args))[1])
    found = jaccard._compare(rows, False)
    assert len(calls) == 0 and len(found)


def test_open_signatures_of_a_task_are_merged(monkeypatch):
    """Each member comes once, in one group with all it has a pair left with."""
    r = np.random.default_rng(6)
    for small in (128, 4):
        monkeypatch.setattr(jaccard, "SMALL_GROUP", small)
        for _ in range(25):
            rows, pairs = member_rows(r, int(r.integers(1, 12)), int(r.integers(9, 40)), int(r.integers(2, 9)))
            compared = jaccard._compare(rows, False)
            found = jaccard._merged(compared)
            given = found[found["open"].isna()]
            given, more = set(zip(given["u"], given["v"])), found[found["open"].notna()]
            assert given == set(zip(*(compared[compared["open"].isna()][c] for c in "uv"))) and not more["u"].duplicated().any()
            group = dict(zip(more["u"], more["open"]))
            assert all(group[u] == group[v] for g in pairs for u, v in pairs[g] - given) and set(group.values()) <= set(rows["sig"])


def test_merged_signatures_are_bounded(monkeypatch):
    """Signatures stay whole, and are merged only as far as a task can hold their sets."""
    r = np.random.default_rng(8)
    for limit in (0, 2000, 5000):
        monkeypatch.setattr(jaccard, "MERGED_SET_BYTES", limit)
        rows, pairs = member_rows(r, 12, 30, 8)
        compared = jaccard._compare(rows, False)
        found, own = jaccard._merged(compared), compared[compared["open"].notna()]
        groups = {g: set(x["u"]) for g, x in found[found["open"].notna()].groupby("open")}
        assert len(own) and all(any(set(x["u"]) <= group for group in groups.values()) for _, x in own.groupby("open"))
        bytes_ = {u: 8 * n + 256 for u, n in zip(own["u"], own["n_u"])}
        largest = max(sum(bytes_[u] for u in x["u"]) for _, x in own.groupby("open"))
        assert all(sum(bytes_[u] for u in group) <= max(limit, largest) for group in groups.values())


@pytest.mark.parametrize("small,kept", [(128, 1 << 17), (4, 3)])
def test_links_that_join_are_found_in_the_task(monkeypatch, small, kept):
    """Only verified links, one less than what they join, and they join what all links join."""
    monkeypatch.setattr(jaccard, "SMALL_GROUP", small)
    monkeypatch.setattr(jaccard, "KEPT_PAIRS", kept)
    r = np.random.default_rng(7)
    for _ in range(30):
        m = int(r.integers(2, 25))
        sets = [np.unique(r.integers(0, 24, int(r.integers(15, 60))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(m)]
        sets = list({jaccard._node(s): s for s in sets}.values())
        m, root = len(sets), r.integers(0, m, len(sets))
        rows = pd.DataFrame([
            {"part": 0, "sig": g, "root": int(root[k]), "node": jaccard._node(sets[k]), "shingles": sets[k].tobytes()}
            for g in range(3) for k in r.choice(m, int(r.integers(1, m + 1)), replace=False)
        ])
        at = {jaccard._node(s): k for k, s in enumerate(sets)}
        found = [(at[u], at[v]) for u, v in jaccard._joining(rows).itertuples(index=False)]
        same = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
        links = [
            (a, b) for _, own in rows.groupby("sig") for a, b in itertools.combinations([at[x] for x in own["node"]], 2)
            if root[a] != root[b] and same(sets[a], sets[b])
        ]

        def joined(edges):
            label = {x: x for x in root.tolist()}
            for u, v in edges:
                a, b = label[root[u]], label[root[v]]
                label = {x: (a if y == b else y) for x, y in label.items()}
            return label

        after = joined(found)
        assert all(same(sets[a], sets[b]) for a, b in found) and len(found) == len(after) - len(set(after.values()))
        assert all(after[root[a]] == after[root[b]] for a, b in links) and len(set(joined(links).values())) == len(set(after.values()))


def test_jaccard_deals_members_evenly(spark, monkeypatch):
    """A task compares so many members, more only where one signature has them."""
    monkeypatch.setattr(jaccard, "MEMBERS_PER_PART", 50)
    known = spark.range(400).selectExpr("id AS key", "cast(cast(id AS string) AS binary) AS node", "20L AS n", "cast('x' AS binary) AS bits")
    members = known.selectExpr("key div 4 AS sig", "key").union(known.selectExpr("(key + 2) div 4 + 1000 AS sig", "key"))
    sizes = []

    def seen(frame, name):
        return frame if name != "found" else sizes.append(frame.rdd.map(lambda x: x["n_u"]).collect()) or frame.where("n_u < 0")

    monkeypatch.setattr(jaccard, "written", seen)
    monkeypatch.setattr(jaccard, "_compare", lambda rows, every: pd.DataFrame(
        {"u": [b""], "v": [b""], "n_u": [len(rows)], "n_v": [0], "open": pd.array([None], "Int64")}))
    jaccard._apart(members, known, known.selectExpr("node", "node AS root").limit(0), False)
    assert sum(sizes[0]) == 796 and max(sizes[0]) < 250


@pytest.fixture
def shuffles(spark, monkeypatch):
    """Shuffles by a key in the plans of what the Jaccard join writes, by label."""
    from revcat.llm import components

    counts, before = collections.Counter(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def counted(frame, name, written=jaccard.written):
        counts[name] += frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        return written(frame, name)

    monkeypatch.setattr(jaccard, "written", counted)
    monkeypatch.setattr(components, "written", counted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield counts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("few", [True, False])
def test_components_of_few_nodes_shuffle_little(spark, monkeypatch, shuffles, few):
    """A path, a star, a cycle, repeated links and a loop: right with and without broadcasts, few shuffles with them."""
    from revcat.llm import components

    if not few:
        monkeypatch.setattr(components, "BROADCAST_NODES", 0, raising=False)
    r = random.Random(1)
    nodes = [f"{x:04d}".encode() for x in r.sample(range(9999), 120)]
    path, star, cycle = nodes[:40], nodes[40:80], nodes[80:]
    edges = [*zip(path, path[1:]), *((star[0], x) for x in star[1:]), *zip(cycle, cycle[1:] + cycle[:1]), (path[0], path[1]), (path[1], path[0])]
    expected = {x: min(part) for part in (path, star, cycle) for x in part}
    frame = spark.createDataFrame([*edges, (b"loop", b"loop")], "u binary, v binary").repartition(3)
    rows = components.components(frame).collect()
    assert len(rows) == len(expected) and {bytes(x["node"]): bytes(x["root"]) for x in rows} == expected
    rounds = len(path).bit_length()
    assert not few or sum(shuffles.values()) <= 2 * rounds


@pytest.mark.parametrize("few", [True, False])
def test_jaccard_shuffles_little_where_rows_are_few(spark, monkeypatch, docs, shuffles, few):
    """Few identifiers are broadcast, so that a small table does not pass some hundred shuffles; the same rows without."""
    from revcat.llm import components

    expected = collections.Counter(map(tuple, jaccard.link_groups(docs).collect()))
    made = sum(shuffles.values())
    if few:
        assert made <= 50
        return
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    monkeypatch.setattr(components, "BROADCAST_NODES", 0, raising=False)
    assert collections.Counter(map(tuple, jaccard.link_groups(docs).collect())) == expected
    assert sum(shuffles.values()) > 2 * made  # nothing was broadcast


@pytest.mark.parametrize("few", [True, False])
def test_jaccard_joins_components_by_further_links(spark, monkeypatch, few):
    """Components from the first comparison that later links join, and texts that only these link."""
    if not few:
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    r = random.Random(8)
    rows, words = [], [f"w{r.randrange(10**6)}" for _ in range(120)]
    for doc in r.sample(range(1000), 90):
        if doc % 3 == 0:
            words = list(words)
            words[r.randrange(120)] = f"x{r.randrange(10**6)}"
        own = list(words)
        own[r.randrange(120)] = f"x{r.randrange(10**6)}"
        rows.append((doc, " ".join(own)))
    found = jaccard.link_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {x["doc_id"]: x["component_id"] for x in found} == grouped(rows)


def test_jaccard_keeps_few_words(monkeypatch):
    """What a worker holds is bounded, however many different words come; the sets are the same."""
    assert jaccard.KEPT_WORDS <= 100_000 and jaccard.FLUSH_SIGNATURES <= 1 << 20
    texts = [" ".join(f"w{k % 700}" for k in range(i, i * 3 + 9)) for i in range(0, 900, 7)]
    many = jaccard._WordHashes()
    expected = [jaccard.shingle_set(t, many).tolist() for t in texts]
    monkeypatch.setattr(jaccard, "KEPT_WORDS", 20)
    few = jaccard._WordHashes()
    for text, shingles in zip(texts, expected):
        assert jaccard.shingle_set(text, few).tolist() == shingles and len(few) <= 20
    assert len(many) == 700


@pytest.mark.parametrize("low,high", [(1, 1), (2, 2), (3, 3), (4, 5), (9, 12), (40, 59), (300, 449)])
def test_linked_sets_share_a_signature(low, high):
    rng, band = np.random.default_rng(low), jaccard.Band(low, high)
    for _ in range(200):
        n = int(rng.integers(low, high + 1))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        drop = int(rng.integers(0, n // 4 + 1))
        b = np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)])
        common = n - drop
        if low <= len(b) <= band.reach and 100 * common >= 75 * (n + len(b) - common):
            assert len(np.intersect1d(band.signatures(np.unique(a)), band.signatures(np.unique(b))))


def test_repeated_bytes(docs):
    rows = corpus()
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = collections.Counter(t[p : p + 200] for t in texts for p in range(len(t) - 199))
    expected = collections.Counter()
    for (doc, *_), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected[doc, len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()] += 1
    found = repeated_bytes.strip_repeats(docs).collect()
    assert collections.Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found) == expected


def test_strings_of_one_rank_are_not_repeats(spark):
    """Two strings of 200 bytes that differ and have the same 64-bit hash."""
    head, tail = "bkqfyyncsqvlynixwwthexdrssqibnnhslsiyrozwopvuxttbj ejk cermqjzfvuuocbtveezmkdvhwcwjklnindvbodkrjffkk", "pmvy"
    a = head + "svavmnarpgqan fncfpbymugemecjxdavhuuzfn tdospmoaputrpmyynrtymtduhqx xiufhvrwzxvrwllhqqpxiylxzxma" + tail
    b = head + "daipllnhtvljsgbzuzvvsfnltoutfplhyzolzkar djcoararkllbqciyxsegdrbuihssn invvanhlhqufvmexqephibvsk" + tail
    at = np.array([0])
    assert a != b and repeated_bytes.Text(a.encode()).rank(at, 200) == repeated_bytes.Text(b.encode()).rank(at, 200)
    removed = lambda *texts: {
        r["doc_id"]: r["n_removed"] for r in repeated_bytes.strip_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    }
    assert removed(a, b) == {0: 0, 1: 0}
    assert removed(a, b, a) == {0: 200, 1: 0, 2: 200}


def tokenizer():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    _, own = tokenizer()
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()
    expected = collections.Counter((doc, np.array(own.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for doc, t, *_ in corpus())
    assert collections.Counter((r["id"], bytes(r["tokens"]), bytes(r["decoded"])) for r in coded) == expected
    assert all(r["n_tokens"] * 4 == len(r["tokens"]) for r in coded)


def test_bpe_words():
    ranks, own = tokenizer()
    r = random.Random(1)
    alphabet = "abc 'é中²½1 \t\n\r\x1c\x1f\xa0\u2003\u3000!?.\u2019st\u0301\U0001f600\u0660\u2160"
    for _ in range(1500):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 14)))
        ids = [i for w in bpe.split_words(text, public_tokenizers.PATTERN) for i in bpe.encode_word(w.encode(), ranks)]
        assert ids == own.encode_ordinary(text)
    for word in (b"a" * 900, bytes(range(256)) * 2, b"ab" * 300):
        assert bpe._by_heap(word, ranks) == bpe._by_scan(word, ranks)


def test_mix(docs):
    rows = [tuple(r) for r in mixing.mix(docs).collect()]
    assert rows and sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in mixing.mix(docs).collect())
    sizes = collections.Counter()
    for _, text, source, *_ in corpus():
        sizes[source] += len(WORD.findall(text or ""))
    left, total, targets = dict(sizes), 1.5 * sum(sizes.values()), {}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    while True:  # share, stop what is above its cap, share the rest again
        level = (total - sum(targets.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            targets[s] = 2.0 * left.pop(s)
    targets |= {s: level * weight[s] for s in left}
    assert collections.Counter((d, n) for d, n, *_ in rows) == collections.Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in corpus())
    taken = collections.Counter()
    by_target = {(sizes[s], round(t, 6)): s for s, t in targets.items()}
    for _, n, of_source, target, words in rows:
        assert 0 <= words <= 2 * n
        taken[by_target[of_source, round(target, 6)]] += words
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK_WORDS + 0.05 * target


def test_mix_of_many_shards_keeps_every_source(spark, monkeypatch):
    """Sources of few blocks, at their cap and not, within a slot of their share however many shards there are."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    sized = spark.createDataFrame([("a", 600), ("b", 60_000), ("c", 70), ("d", 900), ("e", 30_000), (None, 1500)], "source string, size long")
    sources = mixing.targets(sized)
    blocks = sized.selectExpr("source", "ceil(size / 128) AS n_blocks").join(sources.select("source", "number_"), "source")
    blocks = blocks.unionByName(sources.where("source IS NULL").selectExpr("source", "ceil(source_size / 128) AS n_blocks", "number_"))
    sizes = {r["number_"]: (r["n_blocks"], r["target"], r["source_size"]) for r in blocks.join(sources, "number_").collect()}
    assert len(sizes) == 6
    for seed in range(4):
        taken = {r[0]: r[1] for r in mixing._taken_blocks(blocks, sources, seed).groupBy("number_").sum("times").collect()}
        for number, (n_blocks, target, size) in sizes.items():
            assert abs(taken.get(number, 0) - target * n_blocks / size) < 1.5


def test_wordless_rows_are_in_no_window(spark):
    """Else all rows without a word of a source would be sorted by one task."""
    sized = spark.range(300).selectExpr("id AS doc_id", "'a' AS source", "IF(id < 5, id, 0L) AS size")
    packed = mixing._packed(sized, mixing.targets(sized))
    assert sorted((r["doc_id"], r["size"]) for r in packed.collect()) == [(i, i if i < 5 else 0) for i in range(300)]
    assert all(r["at"] == 0 for r in packed.where("size = 0").collect())
    plan = packed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(plan) if "Window" in line and "size" in line)
    depth = len(plan[window]) - len(plan[window].lstrip(" :+-"))
    below = []
    for line in plan[window + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert any("Filter" in line and "> 0" in line for line in below)


def test_mix_does_not_broadcast_blocks(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    blocks = [line for line in plan.splitlines() if "Join" in line and "block" in line]
    assert blocks and all("SortMergeJoin" in line for line in blocks)


def test_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 1000):
        found = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5))).collect()]
        assert sorted(found) == list(range(n))
    assert found != list(range(n))


def test_mixture_keeps_columns(docs):
    assert mixing.mixture(docs).columns == docs.columns


def test_quality_counts(spark):
    texts = ["a b", None, "", "# $% x\nx\nx\n\n", "one two three four five six seven eight " * 3, "é " * 30, "a b c d e f g h i j a b c d e f g h"]
    docs = spark.createDataFrame([(i, t, "s", "q", "r") for i, t in enumerate(texts)], "doc_id long, text string, quality string, kept string, rule string")
    judged = quality_rules.judge(docs, [])
    for row in judged.collect():
        text = row["text"] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        many = collections.Counter(windows)
        repeated = {k for i, w in enumerate(windows) if many[w] > 1 for k in range(i, i + 8)}
        got = row["quality_"]
        assert [got[c] for c in quality_rules.BASE] == [
            len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
        ]
        assert row["kept_"] == (len(words) >= 20 and 100 * len(repeated) <= 30 * len(words))
    assert quality_rules.quality_filter(docs, spark.createDataFrame([], "doc_id long, quality int")).columns == docs.columns


def test_quality_rules_are_learned(spark):
    docs = spark.read.parquet(f"{SF.replace("0.001", "0.01")}/documents.parquet")
    labels = docs.selectExpr("doc_id", "CAST(NOT contains(text, '%') AS int) AS quality")
    rules = quality_rules.learn(docs, labels)
    assert rules and rules[0][0].feature == "symbols_per_word" and rules[0][0].above


def test_url_rules(spark):
    rules = spark.createDataFrame([("org", "/", "allow"), ("a.org", "/x", "block"), ("b.a.org", "/", "allow"), ("com", "", "block")], "host string, path string, verdict string")
    urls = {
        "http://A.org/xy?z": ("a.org", "/xy", "a.org/x", "block"), "http://b.a.org/q": ("b.a.org", "/q", "b.a.org/", "allow"),
        "https://ba.org/x": ("ba.org", "/x", "org/", "allow"), "x://com#/y": ("com", "", "com", "block"), "org/x": ("", "", None, "allow"),
        "http://net/a\n?": ("net", "/a\n", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
    }
    rows = [(i, u, "clash") for i, u in enumerate(urls)] * 2
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, rule string"), rules).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((i, *urls[u])) for i, u, _ in rows)


def test_quotations(spark):
    rows = [
        (1, 0, "u", "Hello  World\nsecond line"), (1, 1, "a", "> hello world\n> second line\n\nMy answer."),
        (1, 2, "u", ">> Hello world\n>> second line\n> My answer.\nThanks"), (1, 3, "u", "> nothing known\nx"),
        (1, 4, "u", "> Thanks\n\nfine"), (2, 0, "u", None), (None, 1, "u", "> b"), (2, 1, "u", "> > deep\nown"), (1, 1, "a", "again"),
    ]
    found = quotations.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    key = lambda r: (r["conv_id"] or 0, r["turn"], r["body"])
    assert [(r["conv_id"], r["turn"], r["body"], r["n_quotes"], r["reply_to"], r["root_turn"], r["depth"]) for r in sorted(found, key=key)] == [
        (None, 1, "", 1, None, 1, 0), (1, 0, "Hello  World\nsecond line", 0, None, 0, 0), (1, 1, "\nMy answer.", 1, 0, 0, 1), (1, 1, "again", 0, 0, 0, 1),
        (1, 2, "Thanks", 2, 1, 0, 2), (1, 3, "x", 1, None, 3, 0), (1, 4, "\nfine", 1, 2, 0, 3), (2, 0, "", 0, None, 0, 0), (2, 1, "own", 1, None, 1, 0),
    ]


def test_quotations_of_a_part(spark):
    three = "First line\nsecond line\nthird line\n\nNext paragraph here\ngoes on\n\nLast paragraph\nends"
    rows = [
        (1, 0, three), (1, 1, "> First line\n> second line\nyes"), (1, 2, "> Next paragraph here\n> goes on\n>\n> Last paragraph\n> ends\nno"),
        (1, 3, "> next paragraph here goes\n> on\n> unknown\nlines break elsewhere"), (1, 4, "> second line\n> third line\n> added by hand\nmost of it"),
        (1, 5, "> First line\n> unknown\nonly half of it"), (1, 6, "second line\nown\nthird line\nadded by hand"),
        (1, 7, "> second line\n> third line\n> added by hand\nall of it, later"), (1, 8, "> nothing\n> of this"), (2, 1, "> First line\n> second line"),
        (1, 9, "> Next paragraph here goes\n> on\n>\n> Last paragraph\n> ends\nrun anew"), (1, None, "> First line\n> second line"),
    ]
    found = quotations.link(spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["turn"]): (r["reply_to"], r["root_turn"], r["depth"]) for r in found} == {
        (1, 0): (None, 0, 0), (1, 1): (0, 0, 1), (1, 2): (0, 0, 1), (1, 3): (None, 3, 0), (1, 4): (0, 0, 1), (1, 5): (None, 5, 0),
        (1, 6): (None, 6, 0), (1, 7): (6, 6, 1), (1, 8): (None, 8, 0), (2, 1): (None, 1, 0), (1, 9): (0, 0, 1), (1, None): (None, None, 0),
    }


def test_main_text(spark):
    html = (
        '<body><div id="cookie-banner">We use cookies</div><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>Title</h1>'
        '<p>One &amp; two<br>three<aside class="sidebar"><p>side</p></aside><p>Four</p></article><div class="comments">'
        "<p>a nice article, thank you for it</p></div><form><label>Name</label><input></form><footer>&copy; us</footer>"
    )
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (1, "u", html), (4, "u", "<p>only</p>")]
    found = html_text.main_text(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")).collect()
    whole = "Title\n\nOne & two three\n\nFour"
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in found) == [(1, whole, len(whole))] * 2 + [(2, "", 0), (3, "", 0), (4, "only", 4)]


def test_main_text_without_end_tags():
    """Pages whose head, svg or math would hide what follows."""
    p, own = "<p>One sentence of the text.</p><p>And another one.</p>", "One sentence of the text.\n\nAnd another one."
    pages = {
        f"<html><head><title>x</title>{p}": own,
        f"<html><head><meta charset=utf-8><script>var a = '<p>';</script><article>{p}</article>": own,
        "<head><title>x</title>Only words here": "Only words here",
        f'<head><title>x</title></head><body><article><svg class="i" viewBox="0 0 1 1"/>{p}</article>': own,
        f"<article><svg><g/><title/><path d='M0'/></svg>{p}<math/></article>": own,
        "<article><p>The sum <math><mi>a</mi><mo>+</mo><mspace/><mi>b</mi></math> is small.</p><p>And another one.</p></article>":
            "The sum a+b is small.\n\nAnd another one.",
        f"<head><style>p {{}}</style><noscript><link></noscript></head><body>{p}": own,
        "<head><title>Only a title</title>": "",
    }
    assert html_text.main_texts(list(pages), html_text.trained()) == list(pages.values())


def test_main_text_of_unseen_layouts():
    trees, right, every = html_text.trained(), 0, 0
    for html in html_text.layouts(200, seed=99):
        page = html_text._Labelled(html)
        kept = html_text.kept_nodes(page.parents, trees.log_odds(html_text.features(page)))
        assert all(kept[page.parents[i]] or not kept[i] for i in range(1, len(kept)))
        right += sum(kept[n] != page.dropped[n] for n, *_ in page.blocks)
        every += len(page.blocks)
    assert right > 0.97 * every


def test_toxicity_is_learned():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 120))) for _ in range(240)]
    labels = [int(i % 5 == 0) for i in range(240)]
    texts = [f"{t} vile {t}" if y else t for t, y in zip(texts, labels)]
    model = toxicity.train(texts[:160], labels[:160])
    scores = toxicity.score_texts(texts[160:], toxicity._Inputs(model))
    assert np.mean((scores >= 0.3) == np.array(labels[160:], bool)) > 0.95
    assert len(toxicity.score_texts(["", " "], toxicity._Inputs(model))) == 2


def test_toxicity_reads_all_windows_of_a_training_text():
    """The one toxic word lies anywhere in texts of thousands of words."""
    r = random.Random(6)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    texts = [[r.choice(words) for _ in range(2500)] for _ in range(40)]
    labels = [i % 2 for i in range(40)]
    for text, label in zip(texts, labels):
        if label:
            text[r.randrange(len(text))] = "vile"
    model = toxicity.train([" ".join(t) for t in texts], labels)
    held = [" ".join(r.choice(words) for _ in range(600)) for _ in range(20)]
    scores = toxicity.score_texts([t + " vile" if i % 2 else t for i, t in enumerate(held)], toxicity._Inputs(model))
    assert np.mean((scores >= 0.3) == np.array([i % 2 for i in range(20)], bool)) > 0.9


def test_trained_model_in_spark(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) + (" vile" if i % 4 == 0 else "") for i in range(300)]
    rows = [(i, t, "e") for i, t in enumerate(texts)]
    odd = [(300, None, "e"), (301, "", "e"), (302, " \n", "e"), (303, "vile " * 20_000, "e"), (304, texts[4], "e"), (304, texts[4], "e"), (None, texts[4], "e")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, id_ string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    found = {}
    for x in toxicity.score(docs, toxicity.learn(docs.drop("id_"), labels)).collect():
        assert x["predicted"] == (x["score"] >= 0.3) and 0 <= x["score"] <= 1
        assert found.setdefault(x["doc_id"], x["score"]) == x["score"]
    assert len(found) == 306 and found[300] == found[301] == found[302] < 0.3 < found[303]
    assert abs(found[304] - found[4]) < 1e-6 and abs(found[None] - found[4]) < 1e-6
    assert np.mean([(found[i] >= 0.3) == (i % 4 == 0) for i in range(300)]) > 0.95


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(rows) == docs.count() and {r["score"] for r in rows} == {0.0}


def test_empty_tables(spark, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    results = [
        exact_dedup.duplicate_groups(none), exact_dedup.exact_dedup(none), jaccard.link_groups(none), jaccard.one_of_each_group(none),
        repeated_bytes.strip_repeats(none), bpe.decode(bpe.encode(none, path, public_tokenizers.PATTERN), path), mixing.mix(none),
        mixing.mixture(none), quality_rules.judge(none, []), toxicity.score(none, None),
        html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")),
        quotations.link(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
        url_filter.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_shards_are_drawn(spark, monkeypatch):
    """Counts of a source differ from shard to shard as multinomial counts do, and add up to its share."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 100)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 4)
    rows = [(i, "w " * 40, "abc"[min(i % 10, 2)]) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.shards(docs).collect()
    assert len({(r["shard"], r["place"]) for r in found}) == len(found)
    counts = {s: collections.Counter(r["shard"] for r in found if r["source"] == s) for s in "abc"}
    n = max(r["shard"] for r in found)  # the last one may be short
    targets = {r["source"]: r["target"] for r in mixing.mix(docs).select("source_size", "target", "doc_id").join(docs, "doc_id").collect()}
    for source, of_shard in counts.items():
        total, share = sum(of_shard.values()), sum(of_shard.values()) / len(found)
        assert abs(total - targets[source] / 4) <= 1
        spread = np.var([of_shard[k] for k in range(n)]) / (100 * share * (1 - share))
        assert 0.6 < spread < 1.5
    taken = collections.Counter((r["source"], r["block"]) for r in found)
    assert max(taken.values()) <= mixing.MAX_PASSES


INTERNAL = "quality_ words_ lines_ counts_ rule_ kept_ copy_ copies_ id_ stays_ id row text_ at block node a.b".split()


@pytest.mark.parametrize("stage", ["quality", "exact", "jaccard", "mixing"])
def test_stages_with_clashing_names(spark, stage):
    """Every column comes out of a stage as it went in, whatever its name."""
    plain = [(i, t, s) for i, t, s, *_ in corpus()[:60]]
    extra = ", ".join(f"`{c}` string" for c in INTERNAL)
    docs = spark.createDataFrame([(*row, *(f"{c}{row[0]}" for c in INTERNAL)) for row in plain], f"doc_id long, text string, source string, {extra}")
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    run = {
        "quality": lambda: quality_rules.quality_filter(docs, labels), "exact": lambda: exact_dedup.exact_dedup(docs),
        "jaccard": lambda: jaccard.one_of_each_group(docs), "mixing": lambda: mixing.mixture(docs),
    }[stage]
    kept = run()
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert rows and all([r[c] for c in INTERNAL] == [f"{c}{r['doc_id']}" for c in INTERNAL] for r in rows)


def test_judge_refuses_names_of_its_result(spark):
    with pytest.raises(ValueError):
        quality_rules.judge(spark.createDataFrame([("a", 1)], "text string, Kept_ int"), [])


def test_tag_soup_never_fails():
    r = random.Random(9)
    parts = ["<p>", "</p>", "<div class='x'>", "</div>", "<![foo[ y ]]>", "<![CDATA[z]]>", "<![", "<!--", "-->", "<!", "<!doctype", "<?", "<a href=\"",
             "\"", "'", ">", "<", "</", "<b", "&amp;", "&#x", "&#99999999;", "text ", "\x00", "<svg/>", "</svg>", "<script>", "</script>", "<td>", "<li>",
             "</nope>", "<math>", "<head>", "<body>", "</html>", "<title>", "]]>", "<p/", "é"]
    for _ in range(4000):
        html = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        page = html_text.Page(html)
        assert len(page.parents) == len(page.tags) and all(text for _, text, _ in page.blocks), html


@pytest.mark.parametrize("html, text", [
    ("<p>x</p><![foo[ y ]]><p>z</p>", "x z"), ("<p>x</p><!-- a <p>y</p>", "x"), ("<p>x</p><a href='y", "x"),
    ("<p>x</p><a href=\"y>t</a><p>z</p>", "x t z"), ("<p>x</p></p", "x"), ("<p>1 < 2</p> <", "1 < 2 <"),
])
def test_unfinished_markup_is_no_text(html, text):
    assert " ".join(t for _, t, _ in html_text.Page(html).blocks) == text


def test_deep_pages_take_linear_time():
    import time

    def seconds(n):
        start = time.process_time()
        html_text.Page("<div>" * n + "</nope>" * n + "<p>a" * n + "</td>" * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(16_000) < 12 * max(seconds(4_000), 0.02)


def test_kept_nodes_is_the_best_labelling():
    r = np.random.default_rng(2)
    for _ in range(200):
        n = int(r.integers(1, 9))
        parents = [-1, *(int(r.integers(0, i)) for i in range(1, n))]
        odds = r.normal(size=n) * 2
        keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)

        def worth(kept):
            return sum(keep[i] if kept[i] else drop[i] for i in range(1, n))

        every = [[bool(bits >> i & 1) or i == 0 for i in range(n)] for bits in range(1 << n)]
        valid = [k for k in every if all(k[parents[i]] or not k[i] for i in range(1, n))]
        assert abs(worth(html_text.kept_nodes(parents, odds)) - max(map(worth, valid))) < 1e-9


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame, expected = QUERIES[name](spark, SF), duck.sql(ORACLES[name])
    rows = sorted(repr([r[c] for c in sorted(frame.columns)]) for r in frame.collect())
    order = sorted(range(len(expected.columns)), key=lambda i: expected.columns[i])
    assert rows == sorted(repr([r[i] for i in order]) for r in expected.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        path = jaccard.written(stage(spark, docs, SF), "test")
        assert path.columns == docs.columns and path.count() > 0
        assert name == "mixing sources" or path.count() <= before
        docs = path
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert coded.count() == docs.count()
