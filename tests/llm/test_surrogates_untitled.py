"""Names that stand without a title after (or before) one with it."""

import re

from plumbline.llm import surrogates as s

ROWS = [(1, "Roe said so. Mr John Roe met Frau Anne-Marie Poe. Later John Roe said, Roe's friend left; Roes, Johnny and ROE stay. Poe, Anne-Marie, Anne."),
        (2, "John Roe without a title."), (3, "Mr James met Mrs James Roe, then James."), (4, "Herr Иванов? Господин Иван Петров, позже Иван, Петров."),
        (5, "Mr Roe"), (6, "mail a@b.org only, John")]


def test_found_names_are_replaced_in_the_whole_document(spark):
    out = {r.doc_id: r for r in s.replace_personal(spark.createDataFrame(ROWS, "doc_id long, text string"), "key").collect()}
    roe = out[5].text[3:]
    m = re.fullmatch(rf"{roe} said so\. Mr (\w+) {roe} met Frau ([\w-]+) (\w+)\. Later \1 {roe} said, {roe}'s friend left; "
                     r"Roes, Johnny and ROE stay\. \3, \2, Anne\.", out[1].text)
    assert m and roe != "Roe" and m[1] != "John" and m[2] != "Anne-Marie"
    assert (out[1].n_surname, out[1].n_given_m, out[1].n_given_f) == (6, 2, 2)
    assert out[2].text == ROWS[1][1]
    m = re.fullmatch(rf"Mr (\w+) met Mrs ([\w-]+) {roe}, then \1\.", out[3].text)
    assert m and "James" not in out[3].text
    m = re.fullmatch(r"Herr (\w+)\? Господин (\w+) (\w+), позже \2, \3\.", out[4].text)
    assert m and "Петров" not in out[4].text
    assert out[6].text.endswith(" only, John")
