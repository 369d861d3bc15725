"""Surrogates: form, distinctness, coreference, collisions, and the edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm import surrogates as s

ROWS = [
    (1, "Mail a.Bc9@mail7.example.com or x@mail7.example.com, call +1 (375) 555-4393 now. Mr John Roe met Mrs. Ann Poe; Mr Roe left."),
    (2, None), (3, ""), (4, "card 4207051279108084 and 4207-0512-7910-8084 ip 49.37.233.206. ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00"),
    (5, "Clean 12 text, v1.2.3 and 1234."), (1, "a.Bc9@mail7.example.com"), (6, "Господин Иван Петров и Госпожа Петров, Κύριος Γιώργος Παππάς"),
    (None, "ann@x.org " * 200), (7, "+1 (375) 555-4393\n49.37.233.206 4207051279108084")]


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


@pytest.fixture(scope="module")
def replaced(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n_ip", F.lit("clash"))
    out = s.replace_personal(docs, "key")
    assert out.columns == ["doc_id", "text", *[f"n_{k}" for k in s.KINDS]]
    return {(r.doc_id, r.n_surname + r.n_phone): r for r in out.collect()}, out.count()


def test_form_and_coreference(replaced):
    rows, count = replaced
    assert count == len(ROWS)
    first, again = rows[1, 4], rows[1, 0]
    m = re.fullmatch(r"Mail ([a-z]\.[A-Z][a-z]\d@([a-z]{4}\d)\.([a-z]{7})\.com) or ([a-z])@\2\.\3\.com, call \+1 \((\d{3})\) \d{3}-\d{4} now\. "
                     r"Mr (\w+) (\w+) met Mrs\. (\w+) (\w+); Mr (\w+) left\.", first.text)
    assert m and m[1] == again.text and "mail7" not in first.text
    assert m[7] == m[10] and m[7] != m[9] and m[6] in s.GIVEN["m", "latin"] and m[8] in s.GIVEN["f", "latin"]
    cards = rows[4, 0].text
    m = re.fullmatch(r"card (\d{16}) and (\d{4}(?:-\d{4}){3}) ip (\d+(?:\.\d+){3})\. ssn (\d{3}-\d{2}-\d{4}) iban (DE\d\d(?: \d{4}){4} \d\d)", cards)
    assert m and luhn(m[1]) and luhn(m[2]) and m[1] != m[2].replace("-", "") and all(int(x) < 256 for x in m[3].split("."))
    assert rows[7, 1].text.split("\n")[1] == f"{m[3]} {m[1]}" and rows[7, 1].text.split("\n")[0] in first.text
    assert re.fullmatch(r"Господин (\w+) (\w+) и Госпожа \2, Κύριος [Α-ώΆ-ώ]+ [Α-ώ]+", rows[6, 3].text)
    assert len(set(rows[None, 0].text.split())) == 1 and rows[None, 0].n_email == 200


def test_texts_without_personal_data_stay(replaced):
    rows, _ = replaced
    texts = dict(ROWS[1:5])
    assert all(rows[i, 0].text == texts[i] for i in (2, 3, 5)) and rows[5, 0].n_card == 0


def test_key_decides_and_empty_table(spark):
    docs = spark.createDataFrame(ROWS[:1], "doc_id long, text string")
    one, two, three = (s.replace_personal(docs, key).first().text for key in ("a", "b", "a"))
    assert one == three != two
    assert s.replace_personal(docs.limit(0), "a").count() == 0


def test_collisions_are_drawn_anew(spark):
    values = spark.createDataFrame([("given_m", f"Name{i}") for i in range(14)] + [("phone", f"+1 {i:02}") for i in range(8)], "kind string, value string")
    got = s.surrogates(values, "key").collect()
    for kind, many in (("given_m", 14), ("phone", 8)):
        mine = [r for r in got if r.kind == kind]
        assert len(mine) == len({r.surrogate for r in mine}) == many
        assert not {r.surrogate for r in mine} & {r.value for r in mine}


def test_exhausted_form_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(s, "MOST_ROUNDS", 2)
    values = spark.createDataFrame([("ssn", str(i)) for i in range(7)], "kind string, value string")
    with pytest.raises(ValueError):
        s.surrogates(values, "key")


def test_query_leaves_no_value_and_changes_nothing_else(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {r.doc_id: r.text for r in s.replace_personal(docs, "key").collect()}
    plain = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|(?<!\w)\d{16}(?!\w)|\+1 \(\d{3}\) \d{3}-\d{4}")
    hit = 0
    for r in docs.collect():
        gaps, found = plain.split(r.text), plain.findall(r.text)
        hit += len(found)
        assert plain.split(out[r.doc_id]) == gaps
        assert not any(value in out[r.doc_id] for value in found)
    assert hit
