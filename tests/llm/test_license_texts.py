"""License scans of the usual hard-wrapped texts."""

import textwrap

import duckdb
import pandas as pd
import pytest

from quarry.llm import license_scan as ls

APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
GPL2 = GPL.replace("software: you", "software; you").replace("version 3", "version 2")
BSD2 = BSD[: BSD.index("3. ")] + BSD[BSD.index("THIS SOFTWARE") :]
TEXTS = {
    "apache-header": APACHE, "apache-short-header": APACHE[: APACHE.index("# Unless")], "gpl-3-header": GPL, "gpl-2-header": GPL2,
    "bsd-3-clause-text": BSD, "bsd-2-clause-text": BSD2, "mit-text": MIT, "mit-grant": MIT[: MIT.index("The above")], "isc-grant": ISC, "mpl-2-notice": MPL,
}


def rules_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.rules for r in ls.scan(docs).orderBy("doc_id").collect()]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_hard_wrapped_texts(spark, ends):
    texts = [("Some title\n\n" + t + "\nint main;\n").replace("\n", ends) for t in TEXTS.values()]
    assert rules_of(spark, texts) == list(TEXTS)


def test_every_rule_fires_on_its_wrapped_sentences(spark):
    for width in (30, 72, 10_000):
        texts = ["\n\n".join("\n".join("// " + x for x in textwrap.wrap(ls.SENTENCES[i] + ".", width)) for i in ids) for _, _, ids in ls.RULES]
        assert rules_of(spark, texts) == [name for name, _, _ in ls.RULES]


def test_a_sentence_needs_both_its_ends(spark):
    assert rules_of(spark, ["It was released under the MIT License.", "Released under the MIT License of old.", "Hello |\nReleased under the MIT license | x"]) == [""] * 3


def test_sql_twin_finds_wrapped_sentences_too(spark):
    texts = [*TEXTS.values(), *(t.replace("\n", "\r\n") for t in TEXTS.values()), *(" ".join(t.split()) for t in TEXTS.values())]
    texts += ["\n\n".join("\n".join("dnl " + x for x in textwrap.wrap(ls.SENTENCES[i] + ".", 40)) for i in ids) for _, _, ids in ls.RULES]
    texts += ["", None, "|a|b. | c", "It was released under the MIT License.", "Hello |\nReleased under the MIT license | x", "É. Released under the mit license!  ü"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    want = con.execute(ls.scan_sql()).fetchall()
    assert sorted(map(tuple, ls.scan(docs).collect())) == sorted(want)
    assert sum(r[3] != "" for r in want) >= 2 * len(TEXTS)
