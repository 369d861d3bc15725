"""The index against direct search, and hit words against a plain scan."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontaminate
from plumbline.llm.fmindex import FMIndex, suffix_order


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_hits(text, windows):
    """``(words, hit words, items)``; windows: tuple of words -> item ids."""
    words, hit, items = plain_words(text), set(), set()
    for size in {len(w) for w in windows}:
        for at in range(len(words) - size + 1):
            found = windows.get(tuple(words[at:at + size]))
            if found:
                items |= found
                hit.update(range(at, at + size))
    return len(words), len(hit), sorted(items)


def plain_windows(benchmark):
    windows = {}
    for name, text in benchmark:
        words = plain_words(text)
        if name is None or not words:
            continue
        for at in range(max(1, len(words) - 9)):
            windows.setdefault(tuple(words[at:at + 10]), set()).add(str(name))
    return windows


@pytest.mark.parametrize("seed,top,repeats", [(1, 3, 1), (2, 1, 2), (3, 50, 30), (4, 4000, 3)])
def test_suffix_order_and_search_agree_with_direct_search(seed, top, repeats):
    rng = np.random.default_rng(seed)
    runs = [rng.integers(1, top + 1, rng.integers(1, 60)) for _ in range(25)] * repeats
    symbols = np.concatenate([[0], *[np.r_[run, 0] for run in runs]])
    ends = np.cumsum(symbols == 0)
    tails = [tuple(np.r_[symbols[i:][:np.argmax(symbols[i:] == 0)], -1, ends[i] + (symbols[i] != 0)])
             for i in range(len(symbols))]
    assert suffix_order(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: tails[i])
    index = FMIndex(symbols, top)
    patterns = np.zeros((40, 6), np.int64)
    lengths = rng.integers(1, 7, 40)
    for row, size in enumerate(lengths):
        at = rng.integers(0, len(symbols) - size)
        piece = symbols[at:at + size]
        patterns[row, 6 - size:] = np.where((piece == 0) | (rng.random(size) < 0.05), 1, piece)
    low, high = index.search(patterns, lengths)
    for row, size in enumerate(lengths):
        want = [i for i in range(len(symbols) - size + 1)
                if (symbols[i:i + size] == patterns[row, 6 - size:]).all()]
        assert sorted(index.locate(np.arange(low[row], max(low[row], high[row])))) == want


BENCHMARK = [(7, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (12, "Short item"),
             (12, "short item"), (3, None), (4, " !! "), (None, "never used words"), (30, "École ß 1984"),
             (8, "x x x x x x x x x x x")]
LONG = "noise word " * 30_000
TEXTS = [(1, "see alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (2, None), (3, ""),
         (4, "short ITEM; short item short"), (5, "École ß 1984"), (6, "école ß 1984 École ß 1984x"),
         (7, "x " * 15), (8, LONG + "short item " + LONG), (None, "short item"), (1, "short item"),
         (9, "short"), (10, "alpha beta gamma delta epsilon zeta eta theta iota"), (11, "never used words"),
         (1, "short item")]


@pytest.mark.parametrize("block_words", [300_000, 6])
def test_hits_items_and_spans(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    windows = plain_windows(BENCHMARK)
    found = decontaminate.find_leaks(docs, bench)
    got = sorted(str((r.doc_id, r.text, r.n_words, r.n_hit, list(r["items"]))) for r in found.collect())
    assert got == sorted(str((i, t, *plain_hits(t, windows))) for i, t in TEXTS)
    for r in found.collect():
        cut = [plain_words(r.text[s.start:s.end]) for s in r.spans]
        assert sum(map(len, cut)) == r.n_hit
        assert all(s.start == 0 or not plain_words(r.text[s.start - 1]) for s in r.spans)
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 6, 9, 10, 11]


def test_empty_tables(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    clean = decontaminate.find_leaks(docs, bench.limit(0)).agg(F.sum("n_hit"), F.sum("n_words"), F.count("*")).first()
    assert tuple(clean) == (0, sum(len(plain_words(t)) for _, t in TEXTS), len(TEXTS))


def test_query_equals_brute_force(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    rows = QUERIES["op1_decontamination"](spark, sf_dir).collect()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = plain_windows(bench)
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words, hits, items = plain_hits(r.text, windows)
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        want.add((r.doc_id, words, hits, len(items), digest, hits > 0))
    assert {tuple(r) for r in rows} == want
    assert any(r.contaminated for r in rows)
