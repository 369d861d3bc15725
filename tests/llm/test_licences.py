"""Known licence texts, near misses, and a plain version of the scan."""

import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm import licences

MIT = """MIT License

Copyright (c) 2019 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE."""
APACHE = """Copyright 2020 Some Authors. All rights reserved.
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

CASES = [
    (MIT, ["MIT"], 0), (APACHE, ["Apache-2.0", "All-rights-reserved"], 0), (GPL, ["GPL-or-later"], 0),
    ("Plain text.\nLicensed under CC BY-NC 4.0.\nMore text", ["CC-BY-NC-4.0"], 0),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"], 0),
    ("x y\nReleased under the MIT License.\nAll rights reserved.", ["MIT", "All-rights-reserved"], 0),
    ("x\nLicensed under the Apache License, Version 2.0.\ny. Licensed under the Apache License, Version 2.0.", ["Apache-2.0"], 0),
    ("He lost his driving licence today.", [], 1), ("A license to kill", [], 1), ("nothing here", [], 0), ("", [], 0), (None, [], 0),
    ("word " * 40_000 + ". All rights reserved.", ["All-rights-reserved"], 0),
]


@pytest.fixture(scope="module")
def scanned(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(CASES)] + [(None, CASES[3][0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unknown", F.lit("clash"))
    return licences.find_licences(docs)


def test_licences_and_unknown_sentences(scanned):
    got = {r.doc_id: (sorted(r.licences), r.unknown) for r in scanned.collect()}
    want = {i: (sorted(names), unknown) for i, (_, names, unknown) in enumerate(CASES)}
    assert got == want | {None: (["CC-BY-NC-4.0"], 0)}


def test_sequence_of_a_full_text(scanned):
    row = scanned.where("doc_id = 0").first()
    assert [s for s in row.sentences if s not in ("Unknown", "Copyright", "MitName")] == \
        ["MitGrant", "MitNotice", "MitAsIs", "MitLiability"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licences.find_licences(docs).count() == 0


def plain(text):
    """Licences named in one-line references, which are the only ones in the given tables."""
    names = {"cc by nc 4 0": "CC-BY-NC-4.0", "gnu general public license version 3": "GPL-3.0",
             "apache license version 2 0": "Apache-2.0", "mit license": "MIT", "all rights reserved": "All-rights-reserved"}
    found = set()
    for sentence in re.split(r"(?<=[.!?:;])\s+|\n", text or ""):
        line = re.sub(r"[\W_]+", " ", sentence.lower()).strip()
        for phrase, name in names.items():
            if re.fullmatch(rf"(?:.* )?(?:licensed|released) under (?:the )?{phrase}", line) or line == phrase == "all rights reserved":
                found.add(name)
    return found


def test_query_equals_plain_version(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_licences"](spark, sf_dir).collect()
    assert {r.doc_id: set(filter(None, r.licences.split(","))) for r in rows} == {i: plain(t) for i, t in texts.items()}
    assert any(r.licences for r in rows)
