"""MinHash near-duplicates against all pairs, signatures, and the edge cases."""

import re
import string
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import common, minhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def plain_classes(docs):
    """docs: list of (id, text); returns (n, smallest id reachable) per place in the list, over all pairs."""
    sets = [plain_set(text) for _, text in docs]
    distinct = {s: i for i, s in reversed(list(enumerate(sets)))}
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        if s:
            root[find(i)] = find(distinct[s])
    holders = {}
    for s, i in distinct.items():
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    near = {pair for some in holders.values() for pair in combinations(some, 2)}
    for i, j in near:
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(docs)
    for members in groups.values():
        ids = [docs[i][0] for i in members if docs[i][0] is not None]
        for i in members:
            out[i] = (len(sets[i]), min(ids, default=None))
    return out


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.withColumns({"n": F.lit("clash"), "node": F.lit(1), "class": F.lit(2), "a.b": F.lit(3), "kept": F.lit(4)})


def found(spark, rows):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows)).collect()), key=repr)


def wanted(rows):
    return sorted(((i, *cell) for (i, _), cell in zip(rows, plain_classes(rows))), key=repr)


def edited(words, rng, edits):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"new{rng.integers(1 << 30)}"
    return " ".join(words)


@pytest.fixture
def rows():
    """A chain of edits, a crowd around one text, dissimilar texts with a common passage, tiny and odd texts."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(10_000)}"
    base = [word() for _ in range(300)]
    chain = [" ".join(base)]
    for _ in range(6):
        chain.append(edited(chain[-1].split(), rng, 4))
    crowd = [edited(base, rng, int(k)) for k in rng.integers(1, 9, 40)]
    passage = " ".join(base[:120])
    sharing = [passage + " " + " ".join(word() for _ in range(80)) for _ in range(25)]
    odd = [None, "", " \t\n", "one", "ONE", "one two", "a b c d e", "a b c d", "a b c d e f g h", "a b c d e f g h i",
           "É é", "é É", "word " * 5000, "word " * 9000, chain[0].upper(), chain[0], chain[0].replace(" ", "\x0b\n")]
    texts = chain + crowd + sharing + odd
    return [(i * 3 % 101 + (i // 101) * 101, t) for i, t in enumerate(texts)] + [(None, chain[3]), (None, "alone"), (7, "x"), (7, "x")]


@pytest.mark.parametrize("share", [1e-4, 0.02, 0.9])
def test_equals_all_pairs_with_hot_and_cold_groups(spark, rows, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_KEYS", share)
    monkeypatch.setattr(minhash, "EDGES_PER_COPY", 7)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4 if share == 0.02 else 2048)
    monkeypatch.setattr(minhash, "MOST_BROADCAST", 0 if share == 0.9 else 1_000_000)
    assert found(spark, rows) == wanted(rows)


def test_query_equals_all_pairs(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op12_minhash"](spark, sf_dir).collect()), key=repr)
    assert got == wanted(docs) and any(i != c for i, _, c in got)


def with_sets(spark, sets):
    rows = [(k, [int(x) for x in v], bytearray(minhash.parities(np.array(list(v), np.uint64)))) for k, v in sets.items()]
    return spark.createDataFrame(rows, "node long, set array<long>, parity binary")


def test_parities_never_differ_more_than_sets():
    rng = np.random.default_rng(2)
    for size in (5, 150, 3000):
        a, b = (np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64)) for _ in range(2))
        b = np.unique(np.r_[a[: 9 * size // 10], b[: size // 10]])
        bits = [np.frombuffer(minhash.parities(x), np.uint64) for x in (a, b)]
        apart = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
        assert 0.7 * len(np.setxor1d(a, b)) <= apart <= len(np.setxor1d(a, b))


def test_no_link_is_lost_where_the_centre_is_far(spark):
    """In one bucket for all, the first centre is close to nobody, and the others hang together in two groups."""
    sets = {0: range(100), 1: range(200, 300), 2: range(205, 305), 3: range(210, 310), 4: range(400, 500), 5: range(402, 502)}
    full = with_sets(spark, sets)
    members = spark.createDataFrame([(1, k, 100, 6) for k in sets], "bucket long, node long, n long, count long")
    links, roots = minhash.connected(members, full)
    assert {tuple(sorted(r)) for r in links.collect()} <= {(1, 2), (2, 3), (1, 3), (4, 5)}
    assert {r.node: r.root for r in roots.collect()} == {2: 1, 3: 1, 5: 4}


def test_edges_of_a_star_grow_with_its_nodes(spark):
    """One bucket of many equal-sized, connected nodes: one edge per node, not one per pair."""
    n = 400
    full = with_sets(spark, {i: [*range(100), 1000 + i] for i in range(n)})
    members = spark.range(n).selectExpr("1L as bucket", "id as node", "101L as n", f"{n}L as count")
    assert minhash.connected(members, full)[0].count() == n - 1


def test_the_centre_of_a_first_star_has_most_company(spark):
    """Node 7 shares every bucket, the others one each: all edges of the first star go out from it."""
    full = with_sets(spark, {i: range(100) for i in range(20)})
    rows = [(b, k, 100, 2) for b in range(20) for k in {b, 7}]
    members = spark.createDataFrame(rows, "bucket long, node long, n long, count long")
    assert {tuple(r) for r in minhash.first_stars(members, full).collect()} == {(7, b) for b in range(20) if b != 7}


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    for size, shared in ((7, 6), (40, 36), (3000, 2700)):
        agree = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * size - shared).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            rng.shuffle(pool)
            a, b = np.sort(pool[:size]), np.sort(pool[size - shared:])
            agree.append(np.mean(minhash.signature(a) == minhash.signature(b)))
        assert abs(np.mean(agree) - shared / (2 * size - shared)) < 0.04


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 1)]
