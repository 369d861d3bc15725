"""Licence scan: sentences become identifiers, and rules match sequences of identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, without

# Known licence sentences, normalised (lower case, only letters, digits and single blanks), as
# anchored patterns. The text of a sentence is public; (?: ...)? holds what licences leave open.
SENTENCES = {
    "Negated": r"(?:.* )?(?:not|never|no longer|isn t|aren t) (?:be )?(?:made )?(?:licensed|released|available|distributed|covered|governed) "
               r"(?:under|by).*",
    "Copyright": r"(?:copyright|c|©) (?:c )?(?:by )?[0-9]{4}.*|copyright (?:c )?.*[0-9]{4}.*",
    "AllRights": r"all rights reserved",
    "AsfAgreements": r"licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements",
    "AsfNotice": r"see the notice file distributed with this work for additional information regarding copyright ownership",
    "MitOrApache": r"(?:.* )?licensed under (?:either )?(?:of )?(?:the )?(?:terms of )?(?:(?:both )?the )?(?:mit(?: licen[sc]e)? (?:and|or) "
                   r"(?:the )?apache(?: licen[sc]e)?(?: version)?(?: 2 0)?|apache(?: licen[sc]e)?(?: version)?(?: 2 0)? (?:and|or) "
                   r"(?:the )?mit)(?: licen[sc]es?)?(?: at your option)?",
    "ApacheRef": r"(?:.* )?(?:licensed|licen[sc]es this (?:file|work|code|software) to you) under the apache licen[sc]e(?: version)? 2 0"
                 r"(?: the licen[sc]e)?"
                 r"(?: you may not use this file except in compliance with the licen[sc]e)?",
    "ApacheNoUse": r"you may not use this file except in compliance with the licen[sc]e",
    "ApacheCopy": r"you may obtain a copy of the licen[sc]e at.*",
    "ApacheBasis": r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is "
                   r"distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "ApacheSee": r"see the licen[sc]e for the specific language governing permissions and limitations under the licen[sc]e",
    "MitRef": r"(?:.* )?(?:released|licensed|available|distributed) under (?:the terms of )?the mit licen[sc]e",
    "MitName": r"(?:the )?mit licen[sc]e(?: mit)?",
    "MitGrant": r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                r"documentation files the software to deal in the software without restriction.*",
    "MitNotice": r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in "
                 r"all copies or substantial portions of the software",
    "MitAsIs": r"the software is provided as is without warranty of any kind express or implied.*",
    "MitLiability": r"in no event shall the authors or copyright holders be liable for any claim damages or other liability.*",
    "BsdGrant": r"redistribution and use in source and binary forms with or without modification are permitted provided that "
                r"the following conditions are met",
    "BsdSource": r"(?:1 )?redistributions of source code must retain the above copyright notice this list of conditions and the "
                 r"following disclaimer",
    "BsdBinary": r"(?:2 )?redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                 r"the following disclaimer in the documentation and or other materials provided with the distribution",
    "BsdEndorse": r"(?:3 )?neither the name of .* nor the names of .* may be used to endorse or promote products derived from "
                  r"this software without specific prior written permission",
    "BsdAsIs": r"this software is provided by .* as is and any express or implied warranties.*",
    "BsdRef": r"(?:.* )?licensed under the (?:[23] clause )?bsd licen[sc]e",
    "IscGrant": r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                r"granted provided that the above copyright notice and this permission notice appear in all copies",
    "Gpl3Ref": r"(?:.* )?licensed under the gnu general public licen[sc]e version 3(?: 0)?",
    "Gpl2Ref": r"(?:.* )?licensed under the gnu general public licen[sc]e version 2(?: 0)?",
    "GplFree": r"(?:this program|.*) is free software you can redistribute it and or modify it under the terms of the gnu general "
               r"public licen[sc]e as published by the free software foundation either version (?:2|3) of the licen[sc]e or "
               r"(?:at your option )?any later version",
    "LgplFree": r"(?:.*) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
                r"licen[sc]e as published by the free software foundation.*",
    "AgplFree": r"(?:.*) is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
                r"licen[sc]e as published by the free software foundation.*",
    "Agpl3Ref": r"(?:.* )?licensed under the (?:gnu )?(?:affero general public licen[sc]e|agpl)(?: version| v)? ?3(?: 0)?(?: licen[sc]e)?",
    "GplReceived": r"you should have received a copy of the gnu (?:lesser |affero )?general public licen[sc]e along with .*",
    "GplIfNot": r"if not see .*gnu org licen[sc]es.*",
    "GplHope": r"(?:.*) is distributed in the hope that it will be useful but without any warranty without even the implied "
               r"warranty of merchantability or fitness for a particular purpose",
    "GplSee": r"see the gnu (?:lesser |affero )?general public licen[sc]e for more details",
    "Mpl2Ref": r"this source code form is subject to the terms of the mozilla public licen[sc]e(?: v)?(?: 2 0)?",
    "CcByNc4": r"(?:.* )?licensed under (?:a )?(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial) 4 0"
               r"(?: international)?(?: licen[sc]e)?",
    "CcBySa4": r"(?:.* )?licensed under (?:a )?(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike) 4 0"
               r"(?: international)?(?: licen[sc]e)?",
    "CcBy4": r"(?:.* )?licensed under (?:a )?(?:cc|creative commons) (?:by|attribution) 4 0(?: international)?(?: licen[sc]e)?",
    "Cc0Ref": r"(?:.* )?(?:licensed|released|available|distributed|dedicated) (?:to the public domain )?under (?:the )?(?:terms of the )?"
              r"(?:cc0|cc 0|creative commons(?: cc0| zero))(?: v)?(?: ?1 0)?(?: universal)?(?: public domain dedication)?(?: licen[sc]e)?",
    "Cc0Waiver": r"to the extent possible under law .* waived all copyright and related or neighbou?ring rights to .*",
    "Epl2": r"(?:.* )?(?:made available|licensed|distributed) under (?:the )?(?:terms of )?(?:the )?eclipse public licen[sc]e(?: version| v)? ?2 0"
            r"(?: which .*)?",
    "Epl1": r"(?:.* )?(?:made available|licensed|distributed) under (?:the )?(?:terms of )?(?:the )?eclipse public licen[sc]e(?: version| v)? ?1 0"
            r"(?: which .*)?",
    "Unlicense": r"this is free and unencumbered software released into the public domain",
    "ZlibAsIs": r"this software is provided as is without any express or implied warranty",
    "ZlibLiability": r"in no event will the authors be held liable for any damages arising from the use of this software",
    "ZlibGrant": r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it "
                 r"and redistribute it freely subject to the following restrictions",
    "BoostRef": r"(?:.* )?(?:distributed|licensed) under the boost software licen[sc]e version 1 0(?: see .*)?",
    "PublicDomain": r"(?:.* )?(?:released into|is in|dedicated to) the public domain",
}
# Licences by the identifiers of SPDX tags. A tag line is a known sentence of its own for each.
TAGS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
TAG = "spdx license identifier"
#: Licences joined in one tag that are told apart; further ones make an unknown sentence.
MOST_IN_TAG = 4
# Ordered licence rules. Sentences of a rule follow each other in a document; copyright lines and
# unknown sentences between them don't matter. A rule that takes a sentence keeps it from the rules below.
RULES = (
    ("Apache-2.0", ("ApacheRef", "ApacheCopy", "ApacheBasis", "ApacheSee")),
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs", "MitLiability")),
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdAsIs")),
    ("LGPL", ("LgplFree", "GplHope", "GplSee")),
    ("AGPL-3.0", ("AgplFree", "GplHope", "GplSee")),
    ("GPL-or-later", ("GplFree", "GplHope", "GplSee")),
    ("Zlib", ("ZlibAsIs", "ZlibLiability", "ZlibGrant")),
    ("MIT OR Apache-2.0", ("MitOrApache",)),
    ("ISC", ("IscGrant",)),
    ("Zlib", ("ZlibGrant",)),
    ("Unlicense", ("Unlicense",)),
    ("CC0-1.0", ("Cc0Waiver",)),
    ("CC0-1.0", ("Cc0Ref",)),
    ("EPL-2.0", ("Epl2",)),
    ("EPL-1.0", ("Epl1",)),
    ("BSL-1.0", ("BoostRef",)),
    ("AGPL-3.0", ("Agpl3Ref",)),
    ("AGPL-3.0", ("AgplFree",)),
    ("Apache-2.0", ("ApacheRef",)),
    ("GPL-3.0", ("Gpl3Ref",)),
    ("GPL-2.0", ("Gpl2Ref",)),
    ("LGPL", ("LgplFree",)),
    ("GPL-or-later", ("GplFree",)),
    ("MPL-2.0", ("Mpl2Ref",)),
    ("MIT", ("MitRef",)),
    ("MIT", ("MitName",)),
    ("BSD", ("BsdRef",)),
    ("CC-BY-NC-4.0", ("CcByNc4",)),
    ("CC-BY-SA-4.0", ("CcBySa4",)),
    ("CC-BY-4.0", ("CcBy4",)),
    ("Public-domain", ("PublicDomain",)),
    ("All-rights-reserved", ("AllRights",)),
)
#: Words without which no sentence speaks of a licence.
TRIGGER = (r"(?i)licen[sc]e|copyright|©|\(c\)|warrant|permission|redistribut|rights reserved|public domain|liable|"
           r"except in compliance|free software|free software foundation|\bcc0\b|creative commons")
#: Where sentences end: marks before a blank, a colon at the end of a line, and lines that are empty or hold
#: comment marks alone.
BREAK = r"(?<=[.!?])\s+|(?<=:)[ \t]*\n|\n[\s*/#;%]*\n"


def normalised(sentence: Column) -> Column:
    """Lower case, with one blank for all that is no letter or digit."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}©]+", " "))


def sentence_id(sentence: Column) -> Column:
    """Identifier of a normalised sentence; ``Unknown`` if no known one. That of a tag names its licence."""
    plain = {re.sub("[^a-z0-9]+", " ", tag.lower()): tag for tag in TAGS}
    tag = f"^{TAG} ({'|'.join(plain)})(?: with .*)?$"
    named = F.create_map(*[F.lit(cell) for pair in plain.items() for cell in pair])
    out = F.when(sentence.rlike(tag), F.concat(F.lit("Tag-"), named[F.regexp_extract(sentence, tag, 1)]))
    for name, pattern in SENTENCES.items():
        out = out.when(sentence.rlike(f"^(?:{pattern})$"), name)
    return out.otherwise("Unknown")


def match_rules(sequence: Column) -> Column:
    """Apply the ordered rules to identifiers joined as ``<A><B>``; returns taken licences and what is left."""
    gap = "((?:<Copyright>|<Unknown>|<ApacheNoUse>|<AsfNotice>|<AsfAgreements>)*)"
    rules = []
    for name, parts in RULES:
        between = "".join(f"${i}" for i in range(1, len(parts)))
        cells = {"name": name, "pattern": gap.join(f"<{part}>" for part in parts), "between": between}
        rules.append(F.struct(*[F.lit(cell).alias(key) for key, cell in cells.items()]))

    def step(state: Column, rule: Column) -> Column:
        hit = F.when(F.regexp_like(state["left"], rule["pattern"]), F.array_append(state["found"], rule["name"])).otherwise(state["found"])
        return F.struct(hit.alias("found"), F.regexp_replace(state["left"], rule["pattern"], rule["between"]).alias("left"))

    tags = F.regexp_extract_all(sequence, F.lit("<Tag-([^>]+)>"), F.lit(1))
    start = F.struct(F.array().cast("array<string>").alias("found"), sequence.alias("left"))
    return F.aggregate(F.array(*rules), start, step, lambda state: F.struct(
        F.concat(state["found"], tags).alias("found"), F.regexp_replace(state["left"], "<Tag-[^>]+>", "").alias("left")))


def find_licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with ``sentences``, ``licences`` and ``unknown`` added.

    A text is cut into sentences; those with a licence word are normalised and mapped to the identifier of a
    known sentence. The identifiers, in the order of the text, are matched against ordered rules: longer
    rules first, and each sentence serves one rule. ``licences`` has each licence once, in the order of the rules, those of tags last;
    ``unknown`` counts sentences with a licence word that no rule or known sentence explains. A sentence that says that a
    text is not under a licence names none. Licences joined by OR or AND in an SPDX tag are named each.
    Everything is an expression on the row: no row moves.

    Null and empty texts have no sentences and no licence. Repeated rows are scanned each; an empty table gives
    no rows. Columns with a result's name are replaced.
    """
    text = quoted(text_col).cast("string")
    speaks = F.coalesce(text.rlike(TRIGGER), F.lit(False))
    parts = F.filter(F.split(_one_tag_per_line(text), BREAK), lambda part: part.rlike(TRIGGER))
    some = F.filter(F.flatten(F.transform(parts, _with_single_lines)), lambda s: s.rlike(TRIGGER))
    found = F.transform(F.transform(some, normalised), sentence_id)
    frame = without(docs, "sentences", "licences", "unknown")
    frame = frame.withColumn("sentences", F.when(speaks, found).otherwise(F.array().cast("array<string>")))
    joined = F.array_join(F.transform("sentences", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), "")
    ruled = frame.withColumn("licences", F.when(F.size("sentences") > 0, F.array_distinct(match_rules(joined)["found"]))
                             .otherwise(F.array().cast("array<string>")))
    return ruled.withColumn("unknown", F.size(F.filter("sentences", lambda s: s == "Unknown")).cast("long"))


def _one_tag_per_line(text: Column) -> Column:
    """SPDX tags of several licences as so many lines; a pass cuts one operator of each tag."""
    out = text
    for _ in range(MOST_IN_TAG - 1):
        out = F.regexp_replace(out, r"(SPDX-License-Identifier:[^\n]*?)[ \t)]+(?:OR|AND)[ \t(]+", "$1\nSPDX-License-Identifier: ")
    return F.when(text.contains("SPDX-License-Identifier:"), out).otherwise(text)


def _with_single_lines(part: Column) -> Column:
    """The lines of a part that are known sentences, and what runs on between them."""
    lines = F.split(part, "\n")
    known = F.transform(F.transform(lines, normalised), lambda line: sentence_id(line) != "Unknown")
    marked = F.zip_with(lines, known, lambda line, alone: F.when(
        alone, F.concat(F.lit("\0"), line, F.lit("\0"))).otherwise(line))
    return F.split(F.array_join(marked, "\n"), "\0")
