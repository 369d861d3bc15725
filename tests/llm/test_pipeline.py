"""The pipeline against plain versions of its stages, one after another, and its edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_boilerplate import plain as plain_lines
from test_decontaminate import plain_hits, plain_windows
from test_mixing import check as check_mix
from test_simhash import plain_fingerprint, plain_groups

import corpus_pipeline
from plumbline.llm import quality
from plumbline.llm.common import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.select(COLUMNS).collect()]


def test_stages_follow_their_plain_versions(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    docs, stage = spark.read.parquet(f"{sf_dir}/documents.parquet"), dict(corpus_pipeline.STAGES)

    good = store(stage[names[0]](spark, docs, sf_dir), "one")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted == 1}
    assert {r[0] for r in rows_of(good)} == kept and good.columns == COLUMNS
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert all(known[i] == (i in kept) for i in known)

    before = rows_of(good)
    lined = store(stage[names[1]](spark, good, sf_dir), "two")
    want = plain_lines([(r[3], r[1]) for r in before])
    assert sorted(rows_of(lined)) == sorted((r[0], w[0], r[2], r[3], len(w[0])) for r, w in zip(before, want))
    assert lined.columns == COLUMNS

    before = sorted(rows_of(lined))
    one = store(stage[names[2]](spark, lined, sf_dir), "three")
    roots = plain_groups(np.array([plain_fingerprint(r[1]) for r in before], np.uint64))
    assert sorted(rows_of(one)) == [r for at, r in enumerate(before) if roots[at] == at] and one.columns == COLUMNS
    assert one.count() < lined.count()

    before = rows_of(one)
    clean = store(stage[names[3]](spark, one, sf_dir), "four")
    windows = plain_windows([(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])
    assert sorted(rows_of(clean)) == sorted(r for r in before if plain_hits(r[1], windows)[1] == 0)
    assert clean.columns == COLUMNS and clean.count() < one.count()

    before = rows_of(clean)
    mixed = stage[names[4]](spark, clean, sf_dir)
    assert mixed.columns == [*COLUMNS, "copies", "taken"]
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    from plumbline.llm import mixing
    check_mix([(r[0], r[3], r[1]) for r in before], found := mixing.mix(clean).collect())
    assert taken == {r.doc_id: r.taken for r in found if r.copies > 0}

    again = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id: r.taken for r in again.collect()} == taken


@pytest.fixture
def odd(spark, tmp_path):
    """Tables with nulls, empty and long texts, repeated rows and a further column."""
    long = "some long words here " * 20_000
    rows = [(1, "a fine text of words. " * 3, "en", "s", 5), (1, "a fine text of words. " * 3, "en", "s", 5), (None, "no id but text", None, "s", None),
            (2, None, "en", None, 0), (3, "", "en", "s", 0), (4, long, None, "t", len(long)), (5, "x\ny\nz", "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("taken", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_rows_go_through(spark, odd):
    out = corpus_pipeline.run(spark, odd)
    assert out.columns == [*COLUMNS, "copies", "taken"]
    got = {r.doc_id: r.taken for r in out.collect()}
    assert set(got) <= {1, None, 4, 5} and got[4] > 0


def test_empty_documents(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{odd}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, odd), name)
        assert docs.count() == 0
