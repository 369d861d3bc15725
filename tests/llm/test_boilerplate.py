"""Site-relative lines against a plain version."""

import re
from collections import Counter

from pyspark.sql import functions as F

from plumbline.llm import boilerplate


def plain(pages, most_share=0.1, least=3):
    """pages: (site, text) rows; returns (text, lines, dropped numbers) per row."""
    tidy = lambda line: re.sub(r"[ \t\r\f\x0b]+", " ", line).strip(" ")
    total = Counter(site for site, _ in pages)
    held = Counter((site, line) for site, text in pages for line in {tidy(x) for x in (text or "").split("\n")} if line)
    out = []
    for site, text in pages:
        lines = text.split("\n") if text is not None else []
        gone = [i for i, line in enumerate(lines, 1) if tidy(line) and held[site, tidy(line)] >= least
                and held[site, tidy(line)] > total[site] * most_share]
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines, 1) if i not in gone) if gone else text
        out.append((kept, sum(bool(tidy(x)) for x in lines), gone))
    return out


def test_lines_nulls_hot_sites_and_clashing_columns(spark, monkeypatch):
    pages = [("a", f"Menu\n own line {i} \n\nfoot  er\t\nMenu" if i % 2 else f"Menu\nown {i}\nfoot er") for i in range(30)]
    pages += [("b", "Menu\nx"), ("b", "Menu\ny"), ("b", None), ("b", ""), (None, "n\nz"), (None, "n"), (None, "n\n"), ("c", "only\n" * 9000)]
    pages += [("a", pages[1][1])] * 2
    for share in (0.001, 0.9):
        monkeypatch.setattr(boilerplate, "HOT_SHARE", share)
        docs = spark.createDataFrame([(i, s, t, "old") for i, (s, t) in enumerate(pages)],
                                     "doc_id long, source string, text string, dropped string")
        found = boilerplate.drop_boilerplate(docs, F.col("source"), F.col("text"))
        assert sorted(found.columns) == ["doc_id", "dropped", "n_dropped", "n_lines", "source", "text"]
        got = {r.doc_id: (r.text, r.n_lines, list(r.dropped)) for r in found.collect()}
        assert got == dict(enumerate(plain(pages)))
        assert all(r.n_dropped == len(r.dropped) for r in found.collect())
    assert boilerplate.drop_boilerplate(docs.limit(0), F.col("source"), F.col("text")).count() == 0


def test_hosts_and_markup(spark):
    rows = [("https://a.example.org:80/x?y#z", "<p>One</p><SCRIPT a>x\ny</script>two<!-- n\n -->three<br>"), (None, None), ("no address", "plain")]
    got = spark.createDataFrame(rows, "url string, html string").select(
        boilerplate.host_of(F.col("url")), boilerplate.page_text(F.col("html"))).collect()
    assert [tuple(r) for r in got] == [("a.example.org", "\nOne\n\ntwo\nthree\n"), ("", None), ("", "plain")]


def test_plan_runs_no_python(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    for name in ("op7_line_dedup", "op8_surrogates", "op9_mixing"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
