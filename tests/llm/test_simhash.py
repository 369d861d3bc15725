"""Fingerprints and groups against plain Python."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import simhash
from plumbline.llm.components import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64)
               if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints, budget=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= budget) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n ", "One", "a b c", "a b c d", "A b\tC d\x0be F g",
                                  "É É ß x   y z", "w " * 5000, "x1 y2 z3 " * 700 + "end"])
def test_fingerprint_is_the_majority_of_shingle_bits(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def cluster(rng, size, flips):
    center = rng.integers(0, 2**63, dtype=np.uint64)
    out = np.full(size, center, np.uint64)
    for _ in range(flips):
        out ^= np.uint64(1) << rng.integers(0, 64, size, dtype=np.uint64)
    return out


def test_trie_join_finds_the_same_trees_as_all_pairs():
    rng = np.random.default_rng(5)
    values = np.unique(np.concatenate([cluster(rng, 300, 2), cluster(rng, 200, 4), cluster(rng, 300, 9),
                                       rng.integers(0, 2**63, 500, dtype=np.uint64),
                                       np.arange(70, dtype=np.uint64)]))
    zero = np.zeros(len(values), np.int64)
    labels = simhash.trie_links(zero, zero, values)
    want = plain_groups(values)
    assert len(set(labels)) == len(set(want)) == len(set(zip(labels, want)))


def test_groups_over_blocks_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(6)
    values = np.unique(np.concatenate([cluster(rng, 400, 3), cluster(rng, 90, 5), cluster(rng, 9, 12)]))
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = components(simhash.near_links(prints), "fp_a", "fp_b").collect()
    root = {r.node: r.root for r in links}
    got = [root.get(int(v), int(v)) for v in values.view(np.int64)]
    want = plain_groups(values)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (100, 101)]
    got = {(r.node, r.root) for r in components(
        spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(i, 100) for i in range(101, 160)}


def test_nulls_copies_empty_tables_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(3, "a b c d e", "x"), (1, "a b c d e", None), (None, "a b c d e", "y"), (4, None, "z"),
            (9, "", None), (5, long, "q"), (6, long, "q"), (6, long, "q"), (None, "lone text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string") \
        .withColumn("group", F.lit(1))
    got = sorted(str((r.doc_id, r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted(map(str, [(None, None), (None, 1), (1, 1), (3, 1), (4, 4), (5, 5), (6, 5), (6, 5), (9, 4)]))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    rows = QUERIES["op2_simhash"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(texts)
    prints = np.array([plain_fingerprint(texts[i]) for i in ids], np.uint64)
    roots = plain_groups(prints)
    want = {(i, f"{int(p):016x}", ids[r]) for i, p, r in zip(ids, prints, roots)}
    assert {tuple(r) for r in rows} == want
