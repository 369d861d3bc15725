"""Repeated passages against a plain version, offsets, and the edge cases."""

import re
from collections import Counter

from pyspark.sql import functions as F

from plumbline.llm import common, substring


def plain_spans(docs):
    """docs: list of (id, text) in reading order; returns spans per place in the list."""
    units, first = [], {}
    for at, (i, text) in enumerate(docs):
        mine = []
        for m in re.finditer(r"[^\n.!?。！？]+[.!?。！？]*|[.!?。！？]+", text or ""):
            key = " ".join(m[0].lower().split())
            if key:
                start = m.start() + len(m[0]) - len(m[0].lstrip())
                mine.append((start, start + len(m[0].strip()), len(key.split()), key))
        units.append(mine)
    order = sorted(range(len(docs)), key=lambda at: (docs[at][0] is not None, docs[at][0] or 0, at))
    for at in order:
        for n, unit in enumerate(units[at]):
            first.setdefault(unit[3], (at, n))
    count = Counter(unit[3] for mine in units for unit in mine)
    out = []
    for at, mine in enumerate(units):
        spans, run = [], []
        for n, unit in enumerate([*mine, None]):
            if unit and count[unit[3]] > 1 and first[unit[3]] != (at, n):
                run.append(unit)
                continue
            if sum(u[2] for u in run if u[2] >= 4) >= 20:
                of = sorted({docs[first[u[3]][0]][0] for u in run} - {None})
                spans.append((run[0][0], run[-1][1], sum(u[2] for u in run), len(run), of))
            run = []
        out.append(spans)
    return out


PASSAGE = ("This passage has several sentences, and each of them has some words. It goes on for a while! Short. "
           "Then it ends with one more sentence of ten words here. And a last one to be over the limit of words.")
ROWS = [(5, "Own start. " + PASSAGE + " Own end."), (2, "Other lead\n" + PASSAGE), (9, "x " + PASSAGE.upper().replace(" ", "  ")),
        (1, "A short line.\nanother"), (3, "A short line.\nsomething else"), (4, None), (6, ""), (7, PASSAGE + "\n" + PASSAGE),
        (8, "word " * 30_000), (10, "word " * 30_000), (None, "Null id first. " + PASSAGE), (11, "ÉÀ😀 " + "ü " * 30 + ".\n" + PASSAGE)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("removed", F.lit("clash"))


def test_spans_match_the_plain_version_with_hot_and_cold_groups(spark, monkeypatch):
    want = {i: spans for (i, _), spans in zip(ROWS, plain_spans(ROWS))}
    assert any(want.values())
    for share in (1e-4, 0.9):
        monkeypatch.setattr(common, "HOT_KEYS", share)
        got = {r.doc_id: [tuple(s) for s in r.spans] for r in substring.repeated_spans(frame(spark)).collect()}
        assert got == want


def test_cut_texts_keep_columns_and_original_offsets(spark):
    docs = frame(spark)
    cut = {r.doc_id: r for r in substring.drop_repeats(docs).collect()}
    assert substring.drop_repeats(docs).columns == ["doc_id", "text", "removed"]
    texts = dict(ROWS)
    for i, r in cut.items():
        kept, at = "", 0
        for s in r.removed:
            kept, at = kept + texts[i][at:s.start], s.end
        assert r.text == (None if texts[i] is None else kept + texts[i][at:])
    assert cut[10].text.strip() == "" and cut[8].text == texts[8] and cut[1].text == texts[1]


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, PASSAGE), (1, PASSAGE), (2, "alone")]
    got = sorted(len(r.spans) for r in substring.repeated_spans(frame(spark, rows)).collect())
    assert got == [0, 0, 1]
    assert substring.repeated_spans(frame(spark).limit(0)).count() == 0
    assert substring.drop_repeats(frame(spark).limit(0)).count() == 0
