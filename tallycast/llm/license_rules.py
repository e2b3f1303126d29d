"""Licence recognition by sentences: known sentences get identifiers, licence
rules are ordered sequences of them.

A text is cut into sentences three times: by lines, by paragraphs (so that wrapped
licence texts are whole), and before every place where a known sentence or a
copyright notice begins (so that a title or a lead-in hides nothing, also in
texts whose lines were joined). Sentences are normalised to lower-case words and
looked up in a fixed table. What is left of a document is a short sequence of sentence
identifiers; a rule matches where its identifiers follow each other with at most
``GAP`` unknown sentences in between. Everything happens within a row, by
DataFrame expressions: there is no shuffle, and no document is compared with
another. Only documents with one of the words that every known sentence contains
are cut at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = 2

# Licence sentences as published, by identifier.
SENTENCES = {
    "all-rights": ["All rights reserved."],
    "mit-released": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.",
                     "Distributed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "mit-name": ["MIT License", "The MIT License (MIT)", "The MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                  "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                  "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
                  "is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "apache-released": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
                        "This project is licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "apache-grant": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "apache-obtain": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                      "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache-asis": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License."],
    "gpl3-work": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.",
                  "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
                     "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl-see": ["See the GNU General Public License for more details."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                  "conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                   "in the documentation and/or other materials provided with the distribution."],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                  "from this software without specific prior written permission."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
                  "that the above copyright notice and this permission notice appear in all copies."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["This work is licensed under CC0 1.0.", "Licensed under CC0 1.0."],
    "gpl2-work": ["SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later",
                  "This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "lgpl21-free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                    "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                   "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl-warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
                      "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "lgpl21-work": ["SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "lgpl3-work": ["SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "agpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                   "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl3-work": ["SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "epl2": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available "
             "at https://www.eclipse.org/legal/epl-2.0/", "SPDX-License-Identifier: EPL-2.0"],
    "bsl1-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                   "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
                   "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to "
                   "do so, all subject to the following:"],
    "bsl1-released": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "zlib-asis": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
                   "redistribute it freely, subject to the following restrictions:"],
    "bsd-spdx3": ["SPDX-License-Identifier: BSD-3-Clause"],
    "bsd-spdx2": ["SPDX-License-Identifier: BSD-2-Clause"],
    "mpl2": ["SPDX-License-Identifier: MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v."],  # "2.0." follows as a sentence of its own
}
# Rules in order of sentences, with the licence they show.
RULES = [
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("mit-notice", "MIT", ["mit-released"]),
    ("mit-title", "MIT", ["mit-name"]),
    ("apache-header", "Apache-2.0", ["apache-grant", "apache-obtain", "apache-asis", "apache-see"]),
    ("apache-short-header", "Apache-2.0", ["apache-grant", "apache-asis"]),
    ("apache-notice", "Apache-2.0", ["apache-released"]),
    ("gpl3-header", "GPL-3.0-or-later", ["gpl-free", "gpl-warranty", "gpl-see"]),
    ("gpl2-header", "GPL-2.0-or-later", ["gpl2-free", "gpl-warranty", "gpl-see"]),
    ("gpl3-notice", "GPL-3.0", ["gpl3-work"]),
    ("gpl2-notice", "GPL-2.0", ["gpl2-work"]),
    ("lgpl21-header", "LGPL-2.1-or-later", ["lgpl21-free", "lgpl-warranty"]),
    ("lgpl21-grant", "LGPL-2.1-or-later", ["lgpl21-free"]),
    ("lgpl3-grant", "LGPL-3.0-or-later", ["lgpl3-free"]),
    ("lgpl21-notice", "LGPL-2.1", ["lgpl21-work"]),
    ("lgpl3-notice", "LGPL-3.0", ["lgpl3-work"]),
    ("agpl3-header", "AGPL-3.0-or-later", ["agpl3-free", "gpl-warranty"]),
    ("agpl3-grant", "AGPL-3.0-or-later", ["agpl3-free"]),
    ("agpl3-notice", "AGPL-3.0", ["agpl3-work"]),
    ("unlicense-text", "Unlicense", ["unlicense"]),
    ("epl2-notice", "EPL-2.0", ["epl2"]),
    ("bsl1-text", "BSL-1.0", ["bsl1-grant"]),
    ("bsl1-notice", "BSL-1.0", ["bsl1-released"]),
    ("zlib-text", "Zlib", ["zlib-asis", "zlib-grant"]),
    ("bsd3-notice", "BSD-3-Clause", ["bsd-spdx3"]),
    ("bsd2-notice", "BSD-2-Clause", ["bsd-spdx2"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("isc-text", "ISC", ["isc-grant"]),
    ("cc-by-nc-notice", "CC-BY-NC-4.0", ["cc-by-nc"]),
    ("cc-by-notice", "CC-BY-4.0", ["cc-by"]),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", ["cc-by-sa"]),
    ("cc0-notice", "CC0-1.0", ["cc0"]),
    ("mpl2-notice", "MPL-2.0", ["mpl2"]),
    ("proprietary-notice", "LicenseRef-all-rights-reserved", ["all-rights"]),
]
# Fixed value: every sentence above contains one of these.
WORDS = "licens|rights|warrant|redistribut|permission|unencumbered"
STARTER_WORDS = 4  # words of a known sentence that begin a sentence wherever they stand

# ends of sentences: a full stop and the like before white space or the end, a colon at a line's end, a blank line
_BREAK = r"(?<=[.!?])(?=\s|$)|(?<=:)(?=[ \t]*\n)|\n[ \t#/*;-]*\n"


def normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def normal_form(sentence: str) -> str:
    """``normal`` for one Python string (the fixed table's entries)."""
    import regex

    return regex.sub(r"[^\p{L}\p{N}]+", " ", sentence.lower()).strip()


def starters() -> list[list[str]]:
    """The first words of every known sentence, at least ``STARTER_WORDS`` and as
    many as no other kind of sentence has within it; a sentence without such a
    beginning is known on its own only."""
    forms = [(name, normal_form(f)) for name, fs in SENTENCES.items() for f in fs]
    heads = {}
    for name, form in forms:
        words = form.split()
        others = [f" {f} " for n, f in forms if n != name]
        for n in range(STARTER_WORDS, len(words) + 1):
            head = " " + " ".join(words[:n]) + " "
            if not any(o.find(head, 1) > 0 for o in others):
                heads[tuple(words[:n])] = None
                break
    return [list(h) for h in heads]


def _starters() -> str:
    """A pattern of places where a known sentence or a copyright notice begins."""
    heads = [r"[^\p{L}\p{N}]+".join(h) for h in starters()]
    return r"(?i)(?<=\s)(?=(?:" + "|".join(heads) + r"|copyright (?:\(c\)|\x{a9}|\d{4}))(?![\p{L}\p{N}]))"


def _table() -> Column:
    pairs = {}
    for name, forms in SENTENCES.items():
        for f in forms:
            pairs[normal_form(f)] = name
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


_CUTS = {"lines": r"\n|" + _BREAK, "paragraphs": _BREAK, "starts": _BREAK + r"|(?<=:)(?=\s+\d+[.)])|" + _starters()}


def known_sentences(text: Column, cut: str) -> Column:
    """array<struct<i, id>>: the known sentences of a text and their numbers
    among its non-empty sentences, in one of the ways of cutting."""
    pieces = F.split(text, _CUTS[cut])
    words = F.filter(F.transform(pieces, normal), lambda s: s != "")
    found = F.transform(words, lambda s, i: F.struct(i.alias("i"), F.try_element_at(_table(), s).alias("id")))
    return F.filter(found, lambda x: x["id"].isNotNull())


def rule_matches(found: Column, gap: int = GAP) -> Column:
    """array<struct<rule, license, first, last, sentences>> over a sequence of known sentences."""
    last = F.size(found) - 1

    def of(rule, license_id, steps):
        n = len(steps)

        def at(p):
            runs = [F.get(found, p + k + 1)["i"] - F.get(found, p + k)["i"] <= gap + 1 for k in range(n - 1)]
            same = [F.get(found, p + k)["id"] == s for k, s in enumerate(steps)]
            return reduce(lambda a, b: a & b, same + runs)

        starts = F.when(last >= n - 1, F.filter(F.sequence(F.lit(0), F.greatest(last - (n - 1), F.lit(0))), at)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda p: F.struct(
            F.lit(rule).alias("rule"), F.lit(license_id).alias("license"), F.get(found, p)["i"].alias("first"),
            F.get(found, p + (n - 1))["i"].alias("last"), F.lit(n).alias("sentences")))

    every = F.concat(*[of(*r) for r in RULES])
    long = F.filter(every, lambda m: m["sentences"] > 1)
    return F.filter(every, lambda m: ~F.exists(long, lambda o: (o["sentences"] > m["sentences"]) & (o["first"] <= m["first"]) & (m["last"] <= o["last"])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = GAP) -> DataFrame:
    """One row per licence rule that a document matches: (doc_id, license, rule,
    matches, sentences), ``matches`` counting the places (the largest of the three
    cuts).

    A rule inside a longer rule's match is part of that one. Null and empty
    texts match nothing; repeated rows are scanned each; a null id is kept; a
    sentence may be repeated any number of times; other columns are ignored.
    """
    hits = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike(f"(?i){WORDS}"))
    seen = hits.select("doc_id", *[known_sentences(F.col("text"), c).alias(c) for c in _CUTS])
    seen = seen.filter(reduce(lambda x, y: x | y, [F.size(c) > 0 for c in _CUTS]))
    each = seen.select("doc_id", *[rule_matches(F.col(c), gap).alias(c) for c in _CUTS])
    names = F.array_distinct(F.transform(F.concat(*_CUTS), lambda m: F.struct(m["license"].alias("license"), m["rule"].alias("rule"), m["sentences"].alias("sentences"))))
    rows = each.select("doc_id", *_CUTS, F.explode(names).alias("m"))
    times = lambda c: F.size(F.filter(c, lambda x: x["rule"] == F.col("m.rule")))
    return rows.select("doc_id", "m.license", "m.rule", F.greatest(*[times(c) for c in _CUTS]).alias("matches"), "m.sentences")
