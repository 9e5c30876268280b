"""License scans by sentence rules.

A text is cut into sentences: after `.`, `;`, `:`, `!` or `?` before white space (but not
after a firm's Inc., Co., Corp. or Ltd. before nor, or, and, be, may), and at line ends. Each is normalised (A-Z lower case, everything but letters a-z and digits one
space) and mapped to the number of a known licence sentence, or to 0. The numbers, in the
text's order, are matched against the rules from the first to the last: a rule is a
licence and the numbers that must follow each other, and what a rule has matched is no
longer there for later ones, so full texts come before their parts. Sentences that name a
holder are known by a pattern with a place for the name, and a clause of a family that is
known in no wording has a number of its own, so that the family's shorter text is not taken
for a licence with another clause. Operators of an SPDX expression are taken for line ends
with the tag said again (up to MAX_IDS ids; what follows WITH is passed over). Licence texts are
often wrapped, so a second reading takes line ends for spaces, but for paragraph ends: lines
without a letter or digit, which may hold spaces, comment marks or carriage returns. Both
readings' licences are returned.

Everything is one projection of built-in functions without a shuffle; the tables of
sentences and rules are literals in it.

Defined cases: null and empty texts have no sentences and no licence; sentences without a
letter (numbers of lists) are passed over; repeated rows are scanned alike; an empty table
gives no rows; other columns are not read.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, by a name of ours.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-line": "Released under the MIT License.",
    "mit-line-licensed": "Licensed under the MIT License.",
    "mit-tag": "SPDX-License-Identifier: MIT",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd-other": "This name may in no case serve to endorse or promote products.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-tag": "SPDX-License-Identifier: Apache-2.0",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-only-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "agpl3-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl3-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "epl2-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense-line": "This is free and unencumbered software released into the public domain.",
    "boost-line": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "gpl3-tag": "SPDX-License-Identifier: GPL-3.0-only",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mpl-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ccby-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbync-line": "Licensed under CC BY-NC 4.0.",
    "ccbync-tag": "SPDX-License-Identifier: CC-BY-NC-4.0",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights": "All rights reserved.",
}

# Identifiers of licences in SPDX tags; those above have rules already.
SPDX_IDS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MPL-2.0", "Unlicense", "Zlib",
)
SENTENCES |= {f"tag-{name}": f"SPDX-License-Identifier: {name}" for name in SPDX_IDS}

# Normalised sentences with a place for a name, and the sentence each is read as.
PATTERNS = (
    ("^neither the names? of .{1,300} nor the names? of (its|their|the|any) contributors may be used to endorse or promote products derived from this software without specific prior written permission$", "bsd-names"),
    ("^the names? of .{1,300} may not be used to endorse or promote products derived from this software without specific prior written permission$", "bsd-names"),
    ("^in no event shall .{1,300} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software$", "mit-liability"),
)
# Words of a family's clause, and the sentence that an unknown one with them is read as.
CLAUSES = (("endorse or promote products", "bsd-other"),)

# Licences by the sentences that make them, in the order they are tried.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-variant", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-other")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-use", "apache-obtain")),
    ("Apache-2.0", ("apache-header", "apache-use")),
    ("ISC", ("isc-grant",)),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-line-licensed",)),
    ("MIT", ("mit-tag",)),
    ("Apache-2.0", ("apache-line",)),
    ("Apache-2.0", ("apache-tag",)),
    ("GPL-3.0", ("gpl3-line",)),
    ("GPL-3.0", ("gpl3-tag",)),
    ("GPL-3.0-or-later", ("gpl3-header",)),
    ("GPL-2.0-or-later", ("gpl2-header",)),
    ("LGPL-2.1-or-later", ("lgpl-header",)),
    ("MPL-2.0", ("mpl-header",)),
    ("CC-BY-4.0", ("ccby-line",)),
    ("CC-BY-SA-4.0", ("ccbysa-line",)),
    ("CC-BY-NC-4.0", ("ccbync-line",)),
    ("CC-BY-NC-4.0", ("ccbync-tag",)),
    ("CC0-1.0", ("cc0-line",)),
    ("GPL-2.0-only", ("gpl2-only-header",)),
    ("AGPL-3.0-or-later", ("agpl3-header",)),
    ("LGPL-3.0-or-later", ("lgpl3-header",)),
    ("EPL-2.0", ("epl2-header",)),
    ("Unlicense", ("unlicense-line",)),
    ("BSL-1.0", ("boost-line",)),
    ("Zlib", ("zlib-as-is", "zlib-liability")),
    *((name, (f"tag-{name}",)) for name in SPDX_IDS),
)

#: Ids that an SPDX expression is split into at most.
MAX_IDS = 6
TAG = "SPDX-License-Identifier:"
_ID = "[A-Za-z0-9.+-]+"
# What follows WITH goes; an operator becomes a line end and the tag.
SPDX_WITH = f"({TAG}[ \\t]*[(]*{_ID}[)]*)[ \\t]+WITH[ \\t]+{_ID}"
SPDX_OPERATOR = f"({TAG})[ \\t]*[(]*({_ID})[)]*[ \\t]+(?:OR|AND)[ \\t]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = "[\\x20\\x09\\x0B-\\x0D]"
# A firm's dot inside a sentence.
FIRM = f"\\b(Inc|INC|Co|CO|Corp|CORP|Ltd|LTD)[.]({_SPACE}+(?:nor|NOR|or|OR|and|AND|be|BE|may|MAY)\\b)"
_PARAGRAPH_END = "\n[^\\p{L}\\p{N}]*\n"


def _sentences(text: str) -> list[str]:
    """The table's own sentences, cut and normalised as texts are."""
    cut = re.sub(f"([.;:!?]){_SPACE}+", "\\1\n", text).split("\n")
    plain = (re.sub("[^a-z0-9]+", " ", part.lower()).strip() for part in cut)
    return [part for part in plain if re.search("[a-z]", part)]


def numbered() -> dict[str, int]:
    """Known normalised sentences and their numbers; some notices are several."""
    parts = dict.fromkeys(part for text in SENTENCES.values() for part in _sentences(text))
    return {part: i + 1 for i, part in enumerate(parts)}


def _one(key: str) -> str:
    """The normalised sentence of a key that is one sentence."""
    (sentence,) = _sentences(SENTENCES[key])
    return sentence


def rule_patterns() -> list[tuple[str, str]]:
    """Licence and the numbers it needs, each between its own spaces."""
    numbers = numbered()
    return [
        (name, "".join(f" {numbers[part]} " for key in keys for part in _sentences(SENTENCES[key])))
        for name, keys in RULES
    ]


def _numbers(text: Column, known: Column) -> Column:
    """Numbers of the text's sentences in order, 0 where unknown."""
    whole = F.regexp_replace(text, FIRM, "$1$2")
    cut = F.split(F.regexp_replace(whole, f"([.;:!?]){_SPACE}+", "$1\n"), "\n")
    plain = F.transform(
        cut, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))
    )
    said = F.filter(plain, lambda s: s.rlike("[a-z]"))
    numbers = numbered()

    def number(sentence):
        for pattern, key in PATTERNS:
            sentence = F.regexp_replace(sentence, pattern, _one(key))
        clause = F.lit(0)
        for words, key in CLAUSES:
            clause = F.when(sentence.contains(words), numbers[_one(key)]).otherwise(clause)
        return F.coalesce(F.element_at(known, sentence), clause)

    return F.transform(said, number)


def _split_tags(text: Column) -> Column:
    """Expressions of SPDX tags as a tag for each id."""
    split = text
    # Each pass takes the first WITH and the first operator after a tag.
    for _ in range(MAX_IDS - 1):
        split = F.regexp_replace(split, SPDX_WITH, "$1")
        split = F.regexp_replace(split, SPDX_OPERATOR, "$1 $2\n$1 ")
    split = F.regexp_replace(split, SPDX_WITH, "$1")
    return F.when(text.contains(TAG), split).otherwise(text)


def _unwrapped(text: Column) -> Column:
    """Line ends as spaces, but for lines without a letter or digit."""
    return F.translate(F.regexp_replace(text, _PARAGRAPH_END, "\x01"), "\n\x01", " \n")


def _licences(numbers: Column, rules: Column) -> Column:
    """Licences of the rules that the numbers meet, in the order of the rules."""
    line = F.concat_ws("", F.transform(numbers, lambda n: F.concat(F.lit(" "), n.cast("string"), F.lit(" "))))
    begin = F.struct(line.alias("line"), F.array().cast("array<string>").alias("found"))

    def apply(state, rule):
        met = F.contains(state["line"], rule["pattern"])
        found = F.when(met, F.array_append(state["found"], rule["licence"])).otherwise(state["found"])
        return F.struct(
            F.replace(state["line"], rule["pattern"], F.lit(" 0 ")).alias("line"), found.alias("found")
        )

    none = F.array().cast("array<string>")
    matched = F.aggregate(rules, begin, apply, lambda state: state["found"])
    return F.when(F.exists(numbers, lambda n: n > 0), matched).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, known (numbers of the known sentences, in order) and licences
    (sorted) of `docs` (doc_id, text)."""
    known = F.create_map(*(F.lit(x) for pair in numbered().items() for x in pair))
    rules = F.array(
        *(
            F.struct(F.lit(name).alias("licence"), F.lit(pattern).alias("pattern"))
            for name, pattern in rule_patterns()
        )
    )
    text = _split_tags(F.coalesce("text", F.lit("")))
    rows = docs.select(
        "doc_id",
        _numbers(text, known).alias("by_line"),
        _numbers(_unwrapped(text), known).alias("unwrapped"),
    )
    both = F.array_union(_licences(F.col("by_line"), rules), _licences(F.col("unwrapped"), rules))
    return rows.select(
        "doc_id",
        F.size("by_line").alias("n_sentences"),
        F.filter("by_line", lambda n: n > 0).alias("known"),
        F.array_sort(both).alias("licences"),
    )
