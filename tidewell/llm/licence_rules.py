"""Licence recognition by sentences.

A text is normalised to lower-case words of letters and digits, with what separates them: blanks, a line break, blank lines, or the end of a
sentence. Sentences of known licences get an identifier where they begin and end at a line break, blank line, sentence end or list number; all other
words get none. Lines may break anywhere inside a sentence. Blank lines and list numbers may stand where the licence has a paragraph of its own, and
need not. A rule is a sequence of identifiers; it fits where its sentences follow one another without other words between them (list numbers aside).
Rules are ordered, those of most sentences first: a rule claims the sentences it fits, so a notice inside a full licence text is not reported again,
while the same notice elsewhere is. Of known sentences that overlap the one of most words counts.

Everything is built-in functions; the tables of sentences and rules are part of the expression.

Defined results: null and empty texts have no licence. Repeated rows are judged row by row. Other columns are ignored, whatever their
names. A sentence of any length is compared whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence texts and notices, as their publishers word them. Blank lines (and list numbers after them) inside a sentence are the
# publishers' paragraphs; between sentences there may be some in any case.
RULES: list[tuple[str, str, str]] = [
    (
        "MIT",
        "text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission"
        " notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT"
        " WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
        " PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR"
        " THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    # The same as it is often quoted, without its last sentence.
    (
        "MIT",
        "excerpt",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission"
        " notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT"
        " WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
        " PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the MIT License."),
    (
        "Apache-2.0",
        "text",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable"
        " law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES"
        " OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and"
        " limitations under the License.",
    ),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    (
        "GPL-3.0",
        "text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This"
        " program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    (
        "BSD-3-Clause",
        "text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions"
        " and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n3. Neither the name"
        " of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission.",
    ),
    (
        "BSD-2-Clause",
        "text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions"
        " and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR"
        " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT"
        " SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
        " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH"
        " THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MPL-2.0",
        "text",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
        " this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "LGPL-3.0",
        "text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This"
        " program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "AGPL-3.0",
        "text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This"
        " program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ),
    (
        "Unlicense",
        "text",
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile,"
        " sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means.",
    ),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Separators of words in a normalised text: a blank, a line break, blank lines, the end of a sentence. What may be a list number is a word ending in N.
BLANK_LINES, END, NUMBER = "P", "S", "N"
EDGE = r"[\nPS]"
#: A number or letter with a full stop or bracket, first in its line or after a sentence mark, colon or semicolon.
LIST_NUMBER = r"(\n[^a-z0-9\n]*+|[.!?:;][ \t\f]++[(\[]?)([0-9]{1,3}|[a-z])[.)](?=[ \t\n\f])"
#: Between two words of a sentence, and where its licence has a paragraph.
GAP, PARAGRAPH = r"[ \n]", r"[ \nP](?:[0-9a-z]+N[\nP])?"


def normalised(text: Column) -> Column:
    """Words and separators of a text, with a separator at both ends."""
    lines = F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), UPPER + "\r", LOWER + "\n")
    steps = [
        (LIST_NUMBER, f"$1$2{NUMBER}\n"),
        # Possessive, and only from the first mark of a run: a long run without white space after it is looked at once.
        (r"(?<![.!?])[.!?]++(?=[ \t\n\f])", END),
        (r"[^a-z0-9NS\n]+", " "),
        (r" ?\n[ \n]*\n ?", BLANK_LINES),
        (r" ?\n ?", "\n"),
        (r"[ \nP]*S[ \nPS]*", END),
    ]
    return reduce(lambda column, step: F.regexp_replace(column, *step), steps, F.concat(F.lit("\n"), lines, F.lit("\n")))


def rule_sentences(text: str) -> list[list[str]]:
    """The words of each sentence of a rule, with an empty one for each paragraph that begins inside it."""
    text = re.sub(r"\n\s*\n\s*(?:[0-9]{1,3}[.)]\s+)?", " \0 ", text)
    out = []
    for part in re.split(r"[.!?]+(?:\s+|$)", text):
        words = re.findall("[a-z0-9]+|\0", part.translate(str.maketrans(UPPER, LOWER)))
        out.append(["" if x == "\0" else x for x in " ".join(words).strip(" \0").split(" ")])
    return [x for x in out if any(x)]


def pattern(words: list[str]) -> str:
    """The normal form of a sentence in any layout; its last word may look like a list number."""
    out, gap = "", ""
    for word in words:
        out += (gap + word + f"{NUMBER}?" * bool(re.fullmatch("[0-9]{1,3}|[a-z]", word))) if word else ""
        gap = GAP if word else PARAGRAPH
    return out


@dataclass(frozen=True)
class Rules:
    """``sentences``: identifier by words of a sentence. ``patterns``: how a text has it. ``ordered``: (licence, kind, identifiers), those of most sentences first."""

    sentences: dict[str, int]
    patterns: dict[int, str]
    ordered: list[tuple[str, str, list[int]]]


def compile_rules(rules: list[tuple[str, str, str]]) -> Rules:
    sentences: dict[str, int] = {}
    layouts: dict[int, set[str]] = {}
    ordered = []
    for licence, kind, text in rules:
        ids = []
        for words in rule_sentences(text):
            ids.append(sentences.setdefault(" ".join(filter(None, words)), len(sentences) + 1))
            layouts.setdefault(ids[-1], set()).add(pattern(words))
        ordered.append((licence, kind, ids))
    longest_first = sorted(sentences, key=lambda x: (-x.count(" "), x))
    patterns = {sentences[x]: "|".join(sorted(layouts[sentences[x]])) for x in longest_first}
    return Rules(sentences, patterns, sorted(ordered, key=lambda x: (-len(x[2]), x[0], x[2])))


def code(ids: list[int]) -> str:
    """A sequence of identifiers as text, each between its own bars."""
    return "".join(f"|{x}|" for x in ids)


def scan(docs: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``doc_id``, ``n_sentences`` (known ones), ``licences`` (names in order, joined by commas, empty without any) and ``n_matches``."""
    known = compile_rules(rules if rules is not None else RULES)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), normalised(text).alias("words"))
    named = F.col("words")
    for number, layout in known.patterns.items():
        named = F.regexp_replace(named, f"({EDGE})(?:{layout})(?={EDGE})", f"$1{code([number])}")
    named = F.regexp_replace(named, f"{EDGE}[0-9a-z]+{NUMBER}(?={EDGE})", "")
    # Other words become a stop; a rule cannot reach across it.
    named = F.regexp_replace(F.regexp_replace(named, rf"{EDGE}[^|\nPS]+", "-"), EDGE, "")
    some = F.col("words").rlike(f"{EDGE}(?:{'|'.join(known.patterns.values())}){EDGE}")
    rows = rows.select("doc_id", F.when(some, named).otherwise("").alias("left"))
    rows = rows.withColumn("n_sentences", (F.length(F.regexp_replace("left", "[^|]", "")) / 2).cast("long"))
    found = []
    for number, (licence, _, sequence) in enumerate(known.ordered):
        mark, size = code(sequence), len(code(sequence))
        rows = rows.withColumn("without", F.replace("left", F.lit(mark), F.lit("-")))
        count = ((F.length("left") - F.length("without")) / (size - 1)).cast("long")
        rows = rows.withColumn(f"n{number}", count).withColumn("left", F.col("without"))
        found.append((licence, F.col(f"n{number}")))
    by_name = {name: [n for licence, n in found if licence == name] for name in sorted({x[0] for x in found})}
    names = F.array_compact(F.array(*[F.when(sum(counts[1:], counts[0]) > 0, F.lit(name)) for name, counts in by_name.items()]))
    total = sum((n for _, n in found[1:]), found[0][1])
    return rows.select("doc_id", "n_sentences", F.array_join(names, ",").alias("licences"), total.alias("n_matches"))


def scan_sql() -> str:
    """The same over table ``documents``, for another engine."""
    known = compile_rules(RULES)
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    ids = ", ".join(f"({quote(s)}, {n})" for s, n in known.sentences.items())
    steps, previous = [], "coded"
    for number, (_, _, sequence) in enumerate(known.ordered):
        mark = code(sequence)
        counts = ", ".join(f"n{x}" for x in range(number))
        steps.append(
            f"step{number} as (select doc_id, row_no, n_sentences, replace(rest, {quote(mark)}, '-') as rest"
            f"{', ' + counts if counts else ''}, cast((length(rest) - length(replace(rest, {quote(mark)}, '-'))) / {len(mark) - 1} as bigint)"
            f" as n{number} from {previous})"
        )
        previous = f"step{number}"
    names = sorted({x[0] for x in known.ordered})
    flags = ", ".join(
        "case when " + " + ".join(f"n{i}" for i, x in enumerate(known.ordered) if x[0] == name) + f" > 0 then {quote(name)} end" for name in names
    )
    total = " + ".join(f"n{x}" for x in range(len(known.ordered)))
    return f"""
with known(sentence, id) as (values {ids}),
numbered as (select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents),
parts as (
  select row_no, unnest(p) as part, unnest(range(len(p))) as place
  from (select row_no, string_split_regex(text, '[.!?]+([ \\t\\r\\n\\f]+|$)|[\\r\\n]+') as p from numbered)
),
clean as (
  select row_no, place, trim(regexp_replace(translate(part, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) as sentence from parts
),
named as (
  select c.row_no, string_agg(coalesce('|' || k.id || '|', '-'), '' order by c.place) as rest, count(k.id) as n_sentences
  from clean c left join known k on k.sentence = c.sentence where c.sentence <> '' group by c.row_no
),
coded as (
  select n.doc_id, n.row_no, coalesce(m.n_sentences, 0) as n_sentences, coalesce(m.rest, '') as rest
  from numbered n left join named m on m.row_no = n.row_no
),
{", ".join(steps)}
select doc_id, cast(n_sentences as bigint) as n_sentences, concat_ws(',', {flags}) as licences, cast({total} as bigint) as n_matches
from {previous}
"""
