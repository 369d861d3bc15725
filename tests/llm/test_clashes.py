"""Columns with the names that operators use inside, names with dots, and many equal rows."""

from plumbline.llm import mixing, simhash, substring

TEXTS = ["A first line of several words here.\n" * 3, "Other words stand in this text, " * 9, None, ""]
INNER = ["_units", "_windows", "_row", "_id", "spans", "removed", "_row_key", "row_key", "fp", "group", "component_id", "fingerprint",
         "unit", "text", "c0", "c1", "a.b", "a`b", "copies", "size", "node", "p", "twins", "twin", "ones", "each", "mine", "i"]


def test_no_column_name_clashes(spark):
    """All these names at once; what stands in them comes out again."""
    rows = [(i, TEXTS[i % len(TEXTS)], "s", *[f"{name} {i}" for name in INNER]) for i in range(12)]
    docs = spark.createDataFrame(rows, f"doc_id long, body string, source string, {', '.join(f'x{i} string' for i in range(len(INNER)))}")
    docs = docs.toDF("doc_id", "body", "source", *INNER)
    kept = simhash.keep_one(docs, "doc_id", "body")
    cut = substring.drop_repeats(docs, "doc_id", "body")
    mixed = mixing.mixed(docs, "doc_id", "body", "source")
    assert kept.columns == docs.columns
    assert cut.columns == [*[c for c in docs.columns if c != "removed"], "removed"]
    assert mixed.columns == [*[c for c in docs.columns if c != "copies"], "copies", "taken"]
    for done in (kept, cut, mixed):
        found = done.collect()
        assert found and all(r[i] == f"{name} {r[0]}" for r in found for i, name in enumerate(done.columns)
                             if name in INNER and name not in ("removed", "copies"))
    assert {r[0] for r in kept.collect()} == {0, 1, 2}


def test_a_third_of_all_rows_is_one_document(spark):
    """Equal rows are counted, not gathered: the largest task of a level holds no more than its fan-in."""
    rows = [(i, "word " * (1 + i % 7), "abc"[i % 3]) for i in range(3000)] + [(9999, "many many words", "a")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    again = sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()), key=repr)
    assert sorted(map(tuple, found), key=repr) == again
    for source in "abc":
        mine = {i for i, _, s in rows if s == source}
        target = next(r.target for r in found if r.doc_id in mine)
        assert abs(sum(r.taken for r in found if r.doc_id in mine) - target) <= 7
    twins = [r.copies for r in found if r.doc_id == 9999]
    assert max(twins) - min(twins) <= 1


def test_twins_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TWINS_AT_ONCE", 4)
    rows = spark.createDataFrame([(1, 1), (2, 11), (3, 4)], "row_key long, twins long")
    found = sorted(map(tuple, mixing._each_twin(rows).select("row_key", "twin").collect()))
    assert found == [(k, t) for k, n in ((1, 1), (2, 11), (3, 4)) for t in range(1, n + 1)]
