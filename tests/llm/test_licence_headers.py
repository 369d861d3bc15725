"""Headers as projects really write them, one per licence, and sentences that name none."""

import pytest

from plumbline.llm import licences

HEADERS = {
    "foundation": ("""/*
 * Licensed to the Apache Software Foundation (ASF) under one or more
 * contributor license agreements.  See the NOTICE file distributed with
 * this work for additional information regarding copyright ownership.
 * The ASF licenses this file to You under the Apache License, Version 2.0
 * (the "License"); you may not use this file except in compliance with
 * the License.  You may obtain a copy of the License at
 *
 *    http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
package x;""", ["Apache-2.0"]),
    "agpl": ("""# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU Affero General Public License for more details.
#
# You should have received a copy of the GNU Affero General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
""", ["AGPL-3.0"]),
    "epl": ("""/* This program and the accompanying materials are made available under the terms of the
 * Eclipse Public License v. 2.0 which is available at
 * https://www.eclipse.org/legal/epl-2.0
 *
 * SPDX-License-Identifier: EPL-2.0
 */""", ["EPL-2.0"]),
    "unlicense": ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.", ["Unlicense"]),
    "zlib": ("""This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""", ["Zlib"]),
    "cc0": ("To the extent possible under law, the author(s) have dedicated and waived all copyright and related or neighboring rights to "
            "this software to the public domain worldwide.", ["CC0-1.0"]),
    "cc0 named": ("The data set is released under CC0 1.0 Universal.", ["CC0-1.0"]),
    "boost": ("//  Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", ["BSL-1.0"]),
    "dual": ("This crate is licensed under the MIT license or the Apache License, Version 2.0.", ["MIT OR Apache-2.0"]),
    "dual at your option": ("Licensed under either of the Apache License, Version 2.0 or the MIT license at your option.", ["MIT OR Apache-2.0"]),
    "mpl": ("""/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */""", ["MPL-2.0"]),
    "tag": ("// SPDX-License-Identifier: Apache-2.0\nint main() { return 0; }", ["Apache-2.0"]),
    "tag with exception": ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", ["GPL-2.0-only"]),
    "tag of several": ("# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nimport x", ["Apache-2.0", "BSD-3-Clause", "MIT"]),
    "two tags": ("SPDX-License-Identifier: ISC\ncode\nSPDX-License-Identifier: Zlib", ["ISC", "Zlib"]),
}
NONE = [
    "This file is not licensed under the MIT license.", "The code is no longer licensed under the Apache License, Version 2.0.",
    "It was never released under the MIT License.", "Their parts are not available under the terms of the MIT license.",
    "SPDX-License-Identifier: LicenseRef-Own", "You need a licence to drive.", "Ask for permission before you copy it.",
    "The eclipse was public. License plates were hidden.", "He was granted permission to use this software.",
]


@pytest.fixture(scope="module")
def found(spark):
    texts = [text for text, _ in HEADERS.values()] + NONE
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: sorted(r.licences) for r in licences.find_licences(docs).collect()}


@pytest.mark.parametrize("name", HEADERS)
def test_header(found, name):
    assert found[list(HEADERS).index(name)] == HEADERS[name][1]


@pytest.mark.parametrize("text", NONE)
def test_sentence_that_names_no_licence(found, text):
    assert found[len(HEADERS) + NONE.index(text)] == []


def test_every_tag_is_a_licence(spark):
    docs = spark.createDataFrame([(tag, f"SPDX-License-Identifier: {tag}") for tag in licences.TAGS], "tag string, text string")
    assert all(r.licences == [r.tag] for r in licences.find_licences(docs).collect())
