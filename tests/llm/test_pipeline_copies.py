"""Copies of a text cast one vote on its lines."""

import corpus_pipeline


def test_a_group_of_copies_keeps_its_text(spark, sf_dir):
    text = "A first clean line.\nA second clean line."
    rows = [(i, text, "en", "s", 40) for i in range(10)]
    rows += [(10 + i, f"Menu\nown words number {i}\nmore of {i}", "en", "s", 40) for i in range(20)]
    rows += [(40, "x\ny", "en", None, 3), (41, "x\ny", "en", None, 3), (42, "x\ny", "en", None, 3), (43, None, "en", None, 0), (44, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lined = corpus_pipeline.line_dedup(spark, docs, sf_dir)
    got = {r.doc_id: r.text for r in lined.collect()}
    assert all(got[i] == text for i in range(10)) and all(got[i] == "x\ny" for i in (40, 41, 42)) and got[43] is got[44] is None
    assert all(got[10 + i] == f"own words number {i}\nmore of {i}" for i in range(20))
    kept = {r.doc_id: r.text for r in corpus_pipeline.simhash_near_dedup(spark, lined, sf_dir).collect()}
    assert text in kept.values() and "x\ny" in kept.values()
