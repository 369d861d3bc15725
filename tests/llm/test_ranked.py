"""Ranked search against plain scoring of every document, block bounds, and the edge cases."""

import math
import re
import string
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import ranked

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_ranks(docs, items):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in counts:
            m = 75 + 25 * c.total() * n // length
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, q in Counter(plain_terms(text)).items() if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, cell[3], -cell[0]) for rank, cell in enumerate(sorted(scored)[:20], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, parts=3):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    docs = docs.withColumns({"n": F.lit("clash"), "terms": F.lit(1), "a.b": F.lit(2), "score": F.lit(3)})
    items = spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit("clash"), "rank": F.lit(1)})
    return sorted((tuple(r) for r in ranked.best_documents(docs, items).collect()), key=repr)


def texts(count, seed, words=400):
    rng = np.random.default_rng(seed)
    odds = 1 / np.arange(1, words + 1)
    return [" ".join(f"W{k}" for k in rng.choice(words, rng.integers(1, 90), p=odds / odds.sum())) for _ in range(count)]


DOCS = [(i, t) for i, t in enumerate(texts(300, 1))] + [
    (400, None), (401, ""), (402, "... --"), (403, "É é ÉCOLE 春天 w1"), (404, "w3 " * 20_000), (None, "w1 w2 w3 w9"), (405, "W5;w5,w5_w5"),
    (7, "w1 w2 w3 w9"), (7, "w1 w2 w3 w9")] + [(500 + i, "w11 w12 w13 same text") for i in range(40)]
ITEMS = [(i, t) for i, t in enumerate(texts(25, 2))] + [
    (30, None), (31, "unknown"), (32, "É école 春天"), (33, "w11 W12 w13"), (33, "w11 W12 w13"), (33, "w1"), (None, "w9 w9 w9 w2"), (34, "w3")]


def test_equals_plain_scores(spark):
    assert found(spark, DOCS, ITEMS) == plain_ranks(DOCS, ITEMS)


def test_equals_plain_scores_in_small_shards_blocks_and_passes(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", 3)
    monkeypatch.setattr(ranked, "ITEM_TERMS", 100)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        assert found(spark, DOCS, ITEMS, parts=2) == plain_ranks(DOCS, ITEMS)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == [] and found(spark, DOCS, []) == []
    assert found(spark, [(1, None)], ITEMS) == []


def shard_of(docs, items):
    asked = ranked.Items.of(items)
    counts = [Counter(asked.vocabulary[t] for t in ranked.terms_of(text) if t in asked.vocabulary) for _, text in docs]
    n = np.array([len(ranked.terms_of(text)) for _, text in docs])
    asked.documents, asked.length = len(docs), int(n.sum())
    df = Counter(t for c in counts for t in c)
    asked.weights = np.array([math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) for t in range(len(asked.vocabulary))])
    sizes = np.array([len(c) for c in counts])
    return asked, ranked.Shard(sizes, np.array([t for c in counts for t in sorted(c)]), np.array([c[t] for c in counts for t in sorted(c)]),
                               n, asked)


def test_bounds_hold_for_every_document_of_every_block():
    docs = [(i, t) for i, t in enumerate(texts(400, 3, 60))]
    asked, shard = shard_of(docs, [(0, "w1 w2 w3 w3 w20 w40"), (1, docs[5][1])])
    for terms, repeats in zip(asked.terms, asked.repeats):
        shard.asked[:] = 0
        shard.asked[terms] = repeats
        for term in terms[shard.most[terms] > 0]:
            of, edges, _, _ = shard.blocks(term)
            assert sorted(of) == sorted(shard.docs[shard.edges[term]:shard.edges[term + 1]])
            for k, bound in enumerate(shard.bounds(term, terms, repeats)):
                assert shard.scores(of[edges[k]:edges[k + 1]]).max() <= bound


def test_most_blocks_are_skipped_where_topics_differ():
    """Documents on 20 topics: an item of one topic reads few lists of the words that all topics share, and not all their blocks."""
    rng = np.random.default_rng(4)
    docs = [(i, " ".join([f"t{i % 20}x{k}" for k in rng.integers(0, 30, 12)] + [f"w{k}" for k in rng.integers(0, 40, 20)])) for i in range(4000)]
    asked, shard = shard_of(docs, [(i, docs[i][1]) for i in range(20)])
    tops, work = [ranked.Top() for _ in asked.ids], Counter()
    ranked.search(shard, np.arange(len(docs)), np.zeros(len(docs), bool), asked, tops, work)
    assert all(top.ids[0] == i for i, top in enumerate(tops))
    assert work["scored"] < 0.1 * 20 * len(docs) and work["read"] < work["blocks"]
