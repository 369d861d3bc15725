"""Passages of short units and of scripts without blanks."""

import re

from plumbline.llm import substring

SHORT = " ".join(f"Word{i}!!" for i in range(30))
CHINESE = "春天来了花园里的花都开了。孩子们在草地上奔跑欢笑。老人坐在长椅上读着报纸。远处的山被薄雾轻轻笼罩着。"
COMMON = [f"c{i}." for i in range(25)]


def spans(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: [(s.start, s.end) for s in r.spans] for r in substring.repeated_spans(docs).collect()}


def test_copies_of_short_units_and_unspaced_text_go(spark):
    verse = "\n".join(f"line number{i}" for i in range(12))
    rows = [(1, SHORT), (2, SHORT), (3, "Lead in here now. " + SHORT + " Own end."), (4, CHINESE), (5, CHINESE), (6, verse), (7, verse + "\nno more")]
    got = spans(spark, rows)
    assert got == {1: [], 2: [(0, len(SHORT))], 3: [(18, 18 + len(SHORT))], 4: [], 5: [(0, len(CHINESE))], 6: [], 7: [(0, len(verse))]}


def test_chance_runs_of_short_units_stay(spark):
    rows = [(1, " ".join(COMMON)), (2, " ".join(reversed(COMMON))), (3, " ".join(COMMON[::2] + COMMON[1::2])), (4, " ".join(COMMON[:19])),
            (5, " ".join(COMMON[:20] + COMMON[22:]))]
    got = spans(spark, rows)
    assert got == {1: [], 2: [], 3: [], 4: [], 5: [(0, len(" ".join(COMMON[:20])))]}


def test_windows_cover_a_shared_stretch():
    starts, ends, words, digests = substring.units_of(SHORT + "\nA line of as many as eight words here.\nEnd.")
    first, last, wide = substring.windows_of(words, digests)
    assert set(range(len(words))) == {u for i, j in zip(first, last) for u in range(i, j + 1)} and len(wide) == 16 * len(first)
    assert all(sum(words[i:j + 1]) >= 20 for i, j in zip(first, last))


def test_query_equals_a_plain_version_of_both_rules(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    units = {i: [(m.start() + len(m[0]) - len(m[0].lstrip()), m.start() + len(m[0].rstrip()), " ".join(m[0].lower().split()))
                 for m in re.finditer(r"[^\n.!?。！？]+[.!?。！？]*|[.!?。！？]+", text) if m[0].strip()] for i, text in docs}
    seen, want, more = set(), {}, 0
    for i, mine in units.items():
        gone, sizes, keys = set(), [len(k.split()) for _, _, k in mine], [k for _, _, k in mine]
        repeats, windows = set(), set()
        for at in range(len(mine)):
            for end in range(at + 1, len(mine) + 1):
                place = tuple(keys[at:end])
                if end == at + 1:
                    repeats |= {at} if place in seen else set()
                    seen.add(place)
                if (n := sum(sizes[at:end])) >= 20:
                    if end > at + 1:
                        windows |= set(range(at, end)) if place in seen else set()
                        seen.add(place)
                    if n - sizes[at] >= 20 or n - sizes[end - 1] >= 20:
                        break
        run = []
        for at in range(len(mine) + 1):
            if at in repeats:
                run.append(at)
                continue
            gone |= set(run) if sum(sizes[u] for u in run if sizes[u] >= 4) >= 20 else set()
            run = []
        more += bool(windows - gone)
        gone |= windows
        starts = [u for u in sorted(gone) if u - 1 not in gone]
        want[i] = ",".join(f"{mine[u][0]}:{mine[next(v for v in range(u, len(mine)) if v + 1 not in gone)][1]}" for u in starts)
    assert {r.doc_id: r.spans for r in QUERIES["op5_substring_dedup"](spark, sf_dir).collect()} == want and more
