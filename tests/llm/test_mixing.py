"""Targets against a plain water level, and the sums, bounds and chances of the rounding."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing


def plain_targets(rows):
    """rows: (source, size)."""
    size = defaultdict(int)
    for source, n in rows:
        size[source] += n
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(size.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * size[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * size[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, found):
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += words(text)
    target = plain_targets([(s, words(t)) for _, s, t in rows])
    source_of = {(i, words(t)): s for i, s, t in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        source = source_of[r.doc_id, r.size]
        assert r.source_size == sizes[source] and abs(r.target - target[source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source] + 1e-6
    assert len(found) == len(rows)
    return taken, target


def test_sources_nulls_repeats_and_long_texts(spark):
    rows = [(i, "bé" if i % 3 else "a", "w " * (1 + i * 7 % 40)) for i in range(700)]
    rows += [(1000 + i, None, "x y z") for i in range(9)] + [(2000, "\U0001f600", "one"), (2001, "￿", "two words"), (2002, "zero", None)]
    rows += [(2003, "zero", " \n"), (2004, "a", "long " * 9000), (None, "a", "null id"), (7, "bé", "same row")] + [(8000, "c", "again a a")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("taken", F.lit("clash"))
    found = mixing.mix(docs).collect()
    check(rows, found)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    kept = mixing.mixed(docs)
    assert kept.columns == ["doc_id", "source", "text", "copies", "taken"]
    assert sum(r.taken for r in kept.collect()) == sum(r.taken for r in found)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_small_nodes_make_a_deeper_tree_with_the_same_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = [(i, "abc"[i % 3], "w " * (1 + i % 23)) for i in range(400)]
    taken, target = check(rows, mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect())
    assert all(abs(taken[s] - target[s]) <= 23 for s in target)


def test_small_and_large_documents_have_the_same_chance(spark):
    rows = [(i, "a", "w " * (5 if i % 2 else 60)) for i in range(2000)] + [(i, "b", "w " * 30) for i in range(2000, 2400)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    rate = plain_targets([(s, words(t)) for _, s, t in rows])["a"] / (1000 * 65)
    for size in (5, 60):
        copies = [r.copies for r in found if r.size == size]
        assert abs(sum(copies) / len(copies) - rate) < 0.06 and {int(rate), int(rate) + 1} >= set(copies)


def test_query_follows_the_contract(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, QUERIES["op9_mixing"](spark, sf_dir).collect())


@pytest.mark.parametrize("text,count", [(None, 0), ("", 0), (" \t\x0b", 0), ("a", 1), (" a b\x0cc ", 2)])
def test_words_are_cut_at_ascii_blanks(spark, text, count):
    assert spark.createDataFrame([(text,)], "t string").select(mixing.word_count(F.col("t"))).first()[0] == count
