"""Licence scan by sentence rules.

1. A text is normalised: lower case, every run of characters that are neither letters nor digits one blank. Places
   where a sentence may begin or end (line breaks, ``. ; :`` before white space, the text's ends) are kept.
2. Known licence sentences are found in the normalised text by an Aho-Corasick automaton; a find counts when it begins
   and ends at such places, so a sentence may be wrapped over lines. Longer finds win over shorter ones they overlap.
   Each find is a sentence identifier. Two kinds of sentence are open: those of ``GAPPED`` hold up to ``NAME_WORDS`` words
   of an owner's name, and ``SPDX-License-Identifier:`` is followed by an expression, which the identifier carries.
3. The sequence of identifiers is matched against the licence rules in their order. A rule is a sequence that must
   occur in order, with at most ``GAP`` other identifiers between; what it matches is used up. Notices that no rule
   uses are reported as ``UNKNOWN`` where they name a licence. An expression is its own rule.

Only the pass over the text depends on its length; a text without any of ``STEMS`` has no known sentence and is done.

Defined cases: a null text is empty and has no licence; repeated rows give repeated results; an empty table gives an
empty result; other columns are not looked at; a text of any length is scanned whole; of finds of one length that
overlap the first wins, at one place the one whose identifier is smaller.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, texts_of

GAP = 3
NAME_WORDS = 12

# Sentences of public licences and usual notices. Identifier -> texts that stand for it.
SENTENCES: dict[str, list[str]] = {
    "mit-name": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
                 "The MIT License (MIT)", "MIT License", "SPDX-License-Identifier: MIT"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                  "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                  "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions "
                   "of the Software"],
    "as-is-software": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                       "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "isc-name": ["Licensed under the ISC License", "ISC License", "SPDX-License-Identifier: ISC"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                  "granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "apache2-name": ["Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")",
                     "Released under the Apache License, Version 2.0", "Apache License Version 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "apache2-comply": ["you may not use this file except in compliance with the License"],
    "apache2-copy": ["You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache2-unless": ["Unless required by applicable law or agreed to in writing, software distributed under the License is "
                       "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                  "following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                   "disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                  "products derived from this software without specific prior written permission"],
    "bsd2-name": ["Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "bsd3-name": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                 "later version",
                 "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                 "License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any "
                 "later version"],
    "gpl2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
                  "later version"],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl3-name": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public "
                  "License, version 3", "SPDX-License-Identifier: GPL-3.0-only"],
    "gpl3-later-name": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl2-name": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public "
                  "License, version 2", "SPDX-License-Identifier: GPL-2.0-only"],
    "lgpl3-name": ["This work is licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"],
    "agpl3-name": ["This work is licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "mpl2-terms": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"],
    "cc-by-nc-4": ["Licensed under CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0",
                   "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-4": ["Licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0",
                "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4": ["Licensed under CC BY-SA 4.0", "SPDX-License-Identifier: CC-BY-SA-4.0",
                   "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "cc-by-nd-4": ["This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "apache2-head": ["Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "gpl3-head": ["GNU GENERAL PUBLIC LICENSE Version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "gpl2-head": ["GNU GENERAL PUBLIC LICENSE Version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "lgpl3-head": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "lgpl21-head": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "agpl3-head": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "lgpl21-free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
                    "option) any later version"],
    "lgpl3-free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your "
                   "option) any later version"],
    "agpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                   "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                   "option) any later version"],
    "lgpl-warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                      "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "mpl2-head": ["Mozilla Public License Version 2.0"],
    "epl2-terms": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                   "which is available at https://www.eclipse.org/legal/epl-2.0/", "Eclipse Public License - v 2.0"],
    "boost-head": ["Boost Software License - Version 1.0", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "boost-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                    "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                    "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
                    "third-parties to whom the Software is furnished to do so, all subject to the following"],
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
                   "alter it and redistribute it freely, subject to the following restrictions"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "reserved": ["All rights reserved"],
}
# Names of licences, for the usual forms of a notice: "Licensed under the <name>", "This code is released under <name>".
NAMES: dict[str, list[str]] = {
    "mit-name": ["MIT License", "MIT Licence", "MIT"],
    "isc-name": ["ISC License"],
    "apache2-name": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "bsd2-name": ["BSD 2-Clause License", "Simplified BSD License"],
    "bsd3-name": ["BSD 3-Clause License", "New BSD License"],
    "gpl3-name": ["GNU General Public License, version 3", "GNU GPL v3"],
    "gpl2-name": ["GNU General Public License, version 2", "GNU GPL v2"],
    "lgpl3-name": ["GNU Lesser General Public License, version 3", "GNU LGPL v3"],
    "lgpl21-name": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"],
    "agpl3-name": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "mpl2-name": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "epl2-name": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0"],
    "boost-name": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "zlib-name": ["zlib License"],
    "cc-by-4": ["CC BY 4.0"], "cc-by-sa-4": ["CC BY-SA 4.0"], "cc-by-nc-4": ["CC BY-NC 4.0"], "cc-by-nd-4": ["CC BY-ND 4.0"],
    "cc0": ["CC0 1.0", "CC0 1.0 Universal"],
    "unlicense": ["Unlicense"],
}
THINGS = ("code", "software", "project", "program", "library", "package", "file", "work", "source code")
VERBS = ("licensed", "released", "distributed", "made available", "available", "published")
# Sentences around a name of 1 to NAME_WORDS words: identifier -> (before, after).
GAPPED: dict[str, list[tuple[str, str]]] = {
    "bsd-names": [("Neither the name of", f"{owners} may be used to endorse or promote products derived from this software without "
                   "specific prior written permission")
                  for owners in ("nor the names of its contributors", "nor the names of other contributors",
                                 "nor the name of its contributors", "nor the names of contributors")]
    + [("The name of", "may not be used to endorse or promote products derived from this software without specific prior "
        "written permission")],
}
# Licence rules in order, the fuller before the shorter.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-name", "mit-grant", "mit-notice", "as-is-software"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is-software"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-name", "isc-grant"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache2-name", "apache2-comply", "apache2-copy", "apache2-unless"]),
    ("Apache-2.0", ["apache2-name", "apache2-comply", "apache2-unless"]),
    ("Apache-2.0", ["apache2-name", "apache2-comply", "apache2-copy"]),
    ("Apache-2.0", ["apache2-name", "apache2-comply"]),
    ("Apache-2.0", ["apache2-name", "apache2-unless"]),
    ("BSL-1.0", ["boost-head", "boost-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("Zlib", ["zlib-name", "zlib-as-is", "zlib-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("BSD-3-Clause", ["bsd3-name", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd2-name", "bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-warranty"]),
    ("LGPL-3.0-or-later", ["lgpl3-free", "lgpl-warranty"]),
    ("AGPL-3.0-or-later", ["agpl3-free", "gpl-warranty"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("MPL-2.0", ["mpl2-terms", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-terms"]),
    ("MIT", ["mit-name"]),
    ("ISC", ["isc-name"]),
    ("Apache-2.0", ["apache2-name"]),
    ("BSD-2-Clause", ["bsd2-name"]),
    ("BSD-3-Clause", ["bsd3-name"]),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("GPL-3.0-or-later", ["gpl3-later-name"]),
    ("GPL-2.0-only", ["gpl2-name"]),
    ("LGPL-3.0-only", ["lgpl3-name"]),
    ("AGPL-3.0-only", ["agpl3-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Apache-2.0", ["apache2-head"]),
    ("GPL-3.0-only", ["gpl3-head"]),
    ("GPL-2.0-only", ["gpl2-head"]),
    ("LGPL-3.0-only", ["lgpl3-head"]),
    ("LGPL-2.1-only", ["lgpl21-head"]),
    ("LGPL-2.1-only", ["lgpl21-name"]),
    ("AGPL-3.0-only", ["agpl3-head"]),
    ("MPL-2.0", ["mpl2-head"]),
    ("MPL-2.0", ["mpl2-name"]),
    ("EPL-2.0", ["epl2-terms"]),
    ("EPL-2.0", ["epl2-name"]),
    ("BSL-1.0", ["boost-head"]),
    ("BSL-1.0", ["boost-name"]),
    ("Zlib", ["zlib-name"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4"]),
]
# Identifiers that name or grant a licence: reported as UNKNOWN when no rule uses them.
GRANTS = {"mit-grant", "isc-grant", "bsd-grant", "apache2-comply", "apache2-unless", "reserved", "boost-grant", "zlib-grant"}
STEMS = ("licen", "permission", "redistribut", "copyright", "warrant", "software", "reserved", "domain", "mpl")

FOUND = "doc_id long, licences string, n_sentences long, sentences string, spans string"

_STEM = re.compile("|".join(STEMS), re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*", re.IGNORECASE)
_SPDX_TOKEN = re.compile(r"[()]|[A-Za-z0-9](?:[A-Za-z0-9.\-]*[A-Za-z0-9+])?")
_SPDX_ID = re.compile(r"[A-Za-z0-9.+\-]*[0-9\-][A-Za-z0-9.+\-]*|MIT|ISC|Zlib|Unlicense|WTFPL|X11|curl|Ruby|Beerware|Intel|NCSA")
_OPERATORS = ("AND", "OR", "WITH")
_BREAK = re.compile(r"[\n\r]|[.;:](?=\s|$)")


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    entries: dict[str, list[tuple[str, int, str]]] = {}

    def add(text: str, name: str, part: str = "whole") -> None:
        words = normal(text)
        if part != "before" and not _STEM.search(words):
            raise ValueError(f"no stem in a sentence of {name}")
        entry = (name, words.count(" ") + 1, part)
        known = entries.setdefault(f" {words} ", [])
        if entry not in known:
            known.append(entry)

    for name, texts in [*SENTENCES.items(), *((n, _notices(names)) for n, names in NAMES.items())]:
        for text in texts:
            add(text, name)
    for name, pairs in GAPPED.items():
        for i, (before, after) in enumerate(pairs):
            add(before, f"{name} {i}", "before")
            add(after, f"{name} {i}", "after")
    found = ahocorasick.Automaton()
    for words, known in entries.items():
        found.add_word(words, known)
    found.make_automaton()
    return found


def _notices(names: list[str]) -> list[str]:
    """The usual notices that name a licence, those that a stem shows."""
    leads = [*VERBS, *(f"this {t} is {v}" for t in THINGS for v in VERBS)]
    every = [f"{lead} under {the}{name}" for lead in leads for the in ("", "the ", "the terms of the ") for name in names]
    return [notice for notice in every if _STEM.search(notice)]


def spdx_expression(text: str, at: int) -> tuple[str, int] | None:
    """The longest licence expression from ``at``, on its line, and where it ends."""
    tokens, depth, operand, good = [], 0, True, 0
    for m in _SPDX_TOKEN.finditer(text, at):
        token = m[0]
        if text[(tokens[-1].end() if tokens else at):m.start()].strip(" \t"):
            break
        if operand:
            if token == "(":
                depth += 1
            elif token in _OPERATORS or not _SPDX_ID.fullmatch(token):
                break
            else:
                operand = False
        elif token == ")" and depth:
            depth -= 1
        elif token in _OPERATORS:
            operand = True
        else:
            break
        tokens.append(m)
        if not operand and not depth:
            good = len(tokens)
    if not good:
        return None
    shown = " ".join(m[0] for m in tokens[:good]).replace("( ", "(").replace(" )", ")")
    return shown, tokens[good - 1].end()


def sentences(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, identifier)`` of known sentences in order, in code points, end exclusive."""
    if not _STEM.search(text):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    if not words:
        return []
    line = " " + " ".join(w.lower() for w in _WORD.findall(text)) + " "
    place = {}  # where a word ends in the normalised text -> its number
    at = 0
    for number, word in enumerate(line.split()):
        at += len(word) + 1
        place[at] = number
    hits, opened, closed = [], [], []
    for end, known in _automaton().iter(line):
        last = place.get(end)
        if last is None:
            continue
        for name, size, part in known:
            first = last - size + 1
            before = text[words[first - 1][1]:words[first][0]] if first else "\n"
            after = text[words[last][1]:words[last + 1][0]] if last + 1 < len(words) else "\n"
            begins, ends = part == "after" or not first or _BREAK.search(before), part == "before" or _BREAK.search(after)
            if begins and ends:
                {"whole": hits, "before": opened, "after": closed}[part].append((first, last, name))
    heads: dict[str, list[tuple[int, int]]] = {}
    for first, last, name in opened:
        heads.setdefault(name, []).append((last, first))
    for first, last, name in closed:
        known = heads.get(name, [])
        i = bisect_left(known, (first - 1, -1)) - 1  # the nearest before, with a word between
        if i >= 0 and first - known[i][0] - 1 <= NAME_WORDS:
            hits.append((known[i][1], last, name.split()[0]))
    starts = None
    for m in _SPDX.finditer(text):
        if expression := spdx_expression(text, m.end()):
            starts = starts or [s for s, _ in words]
            first, last = bisect_left(starts, m.start()), bisect_left(starts, expression[1]) - 1
            hits.append((first, last, f"spdx:{expression[0]}"))
    hits.sort(key=lambda h: (h[0] - h[1], h[0], h[2]))  # the longest first
    taken: list[tuple[int, int, str]] = []
    used: set[int] = set()
    for first, last, name in hits:
        if not any(i in used for i in range(first, last + 1)):
            used.update(range(first, last + 1))
            taken.append((words[first][0], words[last][1], name))
    return sorted(taken)


def licences(found: list[tuple[int, int, str]], gap: int = GAP) -> list[tuple[int, int, str]]:
    """``(start, end, licence)`` by the rules in order; each sentence is used once."""
    free = list(range(len(found)))
    out = []
    for licence, rule in RULES:
        at = 0
        while at < len(free):
            picked, skipped = [], 0
            for i in free[at:]:
                if found[i][2] == rule[len(picked)]:
                    picked.append(i)
                    skipped = 0
                    if len(picked) == len(rule):
                        break
                elif picked:
                    skipped += 1
                    if skipped > gap:
                        break
            if len(picked) == len(rule):
                out.append((found[picked[0]][0], found[picked[-1]][1], licence))
                free = [i for i in free if i not in picked]
            else:
                at = free.index(picked[0]) + 1 if picked else len(free)
    out += [(found[i][0], found[i][1], found[i][2].removeprefix("spdx:")) for i in free if found[i][2].startswith("spdx:")]
    out += [(found[i][0], found[i][1], "UNKNOWN") for i in free if found[i][2] in GRANTS]
    return sorted(out)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Licences, sentence identifiers and spans of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for lo in range(0, batch.num_rows, 64):
                for text in texts_of(batch.column(1).slice(lo, 64)):
                    known = sentences(text)
                    named = licences(known)
                    out[0].append(",".join(dict.fromkeys(n for _, _, n in named)))
                    out[1].append(len(known))
                    out[2].append(",".join(n for _, _, n in known))
                    out[3].append(",".join(f"{n}:{s}:{e}" for s, e, n in named))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds)]],
                                             [f.split()[0] for f in FOUND.split(", ")])

    narrow = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return narrow.mapInArrow(run, FOUND)


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents."""
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op2_licence_scan": op2_licence_scan}
SQL: dict[str, str] = {}
