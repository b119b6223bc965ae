"""Licences in the layouts in which they are distributed."""

from __future__ import annotations

import time

import pytest

from tidewell.llm import licence_rules

PUBLISHED = {
    "MIT": """\
MIT License

Copyright (c) 2024 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "Apache-2.0": """\
   Copyright 2024 Someone

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
""",
    "GPL-3.0": """\
    Copyright (C) 2024  Someone

    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
""",
    "BSD-3-Clause": """\
Copyright 2024 Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
""",
}
PUBLISHED["ISC"] = """\
Copyright 2024 Someone

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
PUBLISHED["MPL-2.0"] = """\
Copyright 2024 Someone

This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
for name, kind in (("LGPL-3.0", "Lesser"), ("AGPL-3.0", "Affero")):
    PUBLISHED[name] = PUBLISHED["GPL-3.0"].replace("GNU General", f"GNU {kind} General")
PUBLISHED["Unlicense"] = """\
Copyright 2024 Someone

This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
HEAD, _, TAIL = PUBLISHED["BSD-3-Clause"].partition("3. Neither")
PUBLISHED["BSD-2-Clause"] = HEAD + TAIL[TAIL.index("THIS SOFTWARE") :]


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(row.licences, row.n_matches) for row in licence_rules.scan(docs).orderBy("doc_id").collect()]


def test_texts_as_published(spark):
    """The rules of whole texts, each once and without a notice inside it."""
    assert sorted(PUBLISHED) == sorted(name for name, kind, _ in licence_rules.RULES if kind == "text")
    assert scanned(spark, PUBLISHED.values()) == [(name, 1) for name in PUBLISHED]


LAYOUTS = {
    "carriage returns": lambda x: x.replace("\n", "\r\n"),
    "old line ends": lambda x: x.replace("\n", "\r"),
    "indented": lambda x: x.replace("\n", "\n\t    "),
    "comment": lambda x: "/*\n * " + x.replace("\n", "\n * ") + "\n */",
    "hash comment": lambda x: "# " + x.replace("\n", "\n# "),
    "one line": lambda x: " ".join(x.split()),
    "a word a line": lambda x: "\n".join(x.split()),
    "paragraphs unwrapped": lambda x: "\n\n".join(" ".join(part.split()) for part in x.split("\n\n")),
    "no blank lines": lambda x: x.replace("\n\n", "\n"),
    "numbers in brackets": lambda x: x.replace("1.", "(1)").replace("2.", "(2)").replace("3.", "(3)") if "1. " in x else x,
    "bullets": lambda x: x.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ") if "1. " in x else x,
    "heading without a full stop": lambda x: "Licence of this page\n" + x.split("\n\n", 2 if x.startswith("MIT") else 1)[-1],
    "capitals": str.upper,
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_texts_in_other_layouts(spark, layout):
    texts = {name: LAYOUTS[layout](text) for name, text in PUBLISHED.items()}
    if layout == "one line":  # the line of the copyright has no end there
        texts = {name: LAYOUTS[layout](text.split("\n\n", 2 if name == "MIT" else 1)[-1]) for name, text in PUBLISHED.items()}
    assert scanned(spark, texts.values()) == [(name, 1) for name in texts]


def test_notices_broken_at_each_blank(spark):
    broken = []
    for name, kind, text in licence_rules.RULES:
        words = text.split(" ")
        if kind == "notice":
            for place in range(1, len(words)):
                head, tail = " ".join(words[:place]), " ".join(words[place:])
                broken.append((name, f"A heading\n{head}\n{tail}\n\nOther words follow."))
                broken.append((name, f"Words before.\n// {head}\r\n// {tail} Other words follow."))
    assert len(broken) > 100
    assert scanned(spark, [text for _, text in broken]) == [(name, 1) for name, _ in broken]


def test_what_is_no_licence(spark):
    mit, bsd = PUBLISHED["MIT"], PUBLISHED["BSD-3-Clause"]
    texts = [
        "Not licensed under the\nMIT License.",
        "Licensed under the. MIT License.",  # a sentence ends between
        "Licensed under the\n\nMIT License.",  # no paragraph of the notice
        "Licensed under the\n1. MIT License.",
        mit.replace("THE SOFTWARE IS", "Other words.\n\nTHE SOFTWARE IS"),
        mit.replace("free of charge, ", ""),
        bsd.replace("2. Red", "2. Other words.\n\n3. Red").replace("3. Neither", "4. Neither"),
        "\n" * 200_000 + ". " * 200_000 + " \n" * 200_000,
    ]
    assert scanned(spark, texts) == [("", 0)] * len(texts)
    counts = licence_rules.scan(spark.createDataFrame([(1, bsd)], "doc_id long, text string")).collect()
    assert counts[0].n_sentences == 3


@pytest.mark.parametrize("unit", [".", "!?", " ", "\n", "\t", ". ", "\n1. ", "1.", "a) ", "x ", "x.\n\n"])
def test_time_is_in_proportion_to_length(spark, unit):
    """A million characters of one kind, with a notice behind them."""
    texts = [unit * (1_000_000 // len(unit)) + "\n\nLicensed under CC BY 4.0.\n"]
    started = time.monotonic()
    assert scanned(spark, texts) == [("CC-BY-4.0", 1)]
    assert time.monotonic() - started < 60
