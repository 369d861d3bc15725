"""Licences in comments and directly below a copyright line."""

from test_licences import GPL, MIT

from plumbline.llm import licences


def test_notices_in_comments_are_found(spark):
    body = MIT.split("\n", 2)[2]
    dense = "Copyright (c) 2019 Someone\n" + body.split("\n\n", 1)[1]
    isc = ("Copyright (c) 2019 Someone\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee "
           "is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.")
    texts = [dense, isc, "Copyright 2019 X\n" + GPL]
    texts += [mark[0] + "\n".join((mark[1] + line).rstrip() for line in text.split("\n")) + mark[2]
              for text in (body, dense, isc) for mark in (("/*\n", " * ", "\n */"), ("", "// ", ""), ("", "# ", ""))]
    got = licences.find_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = ["MIT", "ISC", "GPL-or-later", *["MIT"] * 6, *["ISC"] * 3]
    assert {r.doc_id: list(r.licences) for r in got.collect()} == {i: [name] for i, name in enumerate(want)}
