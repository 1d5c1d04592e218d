"""Licence recognition by sentence rules.

A text is its words (lower case, letters and digits).  A known licence sentence may start and end at any word, within a longer sentence
or over wrapped lines; the longest one that starts at a word becomes an identifier, and the search goes on after it.  A rule is an
ordered sequence of identifiers; rules with more sentences go first, each identifier serves one rule and joins the nearest
one before it, however far apart they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_map

# Sentences of public licence texts and notices.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-notice-defined": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-may-not": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc0": "Licensed under CC0 1.0",
    "gpl-work-3": "This work is licensed under the GNU General Public License, version 3",
    "gpl-work-2": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free-3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-free-2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-see": "See the GNU General Public License for more details",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program",
    "mit-notice": "Released under the MIT License",
    "mit-notice-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice-kept": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
}
# Licence identifiers and the sentences that make them, in order.
RULES = [
    ("Apache-2.0", ("apache-notice-defined", "apache-may-not", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-notice-defined", "apache-may-not")),
    ("Apache-2.0", ("apache-notice",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC0-1.0", ("cc0",)),
    ("GPL-2.0-or-later", ("gpl-free-2", "gpl-hope", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-free-2",)),
    ("GPL-2.0-only", ("gpl-work-2",)),
    ("GPL-3.0-or-later", ("gpl-free-3", "gpl-hope", "gpl-see", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl-free-3",)),
    ("GPL-3.0-only", ("gpl-work-3",)),
    ("MIT", ("mit-title", "mit-grant", "mit-notice-kept")),
    ("MIT", ("mit-grant", "mit-notice-kept")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-licensed",)),
    ("MIT", ("mit-title",)),
]
def _family(short: str, name: str, versions: list[str]) -> dict[str, list[str]]:
    """Names of the licences of a GNU family: one version only, and or later."""
    out = {}
    for v in versions:
        numbers = list(dict.fromkeys((v, v.removesuffix(".0"))))
        forms = [f"{lead}{x}{how}{n}" for lead in ("the GNU ", "GNU ", "the ") for x in (name, short) for how in (" version ", " v", " v ", " ") for n in numbers]
        forms += [f"{the}{short}{how}{n}" for the in ("the ", "") for how in (" version ", " v", "v", " v ", " ") for n in numbers]
        forms += [f"version {n} of the {gnu}{x}" for n in numbers for gnu in ("GNU ", "") for x in (name, short)]
        out[f"{short}-{v}-only"] = [*forms, *(f"{x} only" for x in forms)]
        out[f"{short}-{v}-or-later"] = [f"{x}{tail}" for x in forms for tail in (" or later", " or newer", " or any later version", " or (at your option) any later version", "+")]
    return out


def _creative(code: str, words: str) -> list[str]:
    return [f"{the}{x}" for the in ("the ", "a ", "") for x in (f"CC {code} 4.0", f"CC-{code}-4.0 license", f"Creative Commons {words} 4.0", f"Creative Commons {words} 4.0 License", f"Creative Commons {words} 4.0 International", f"Creative Commons {words} 4.0 International License")]


def _named(*names: str) -> list[str]:
    return [f"{the}{x}" for the in ("the ", "a ", "an ", "") for x in names]


#: The names under which notices speak of a licence.
NAMES = {
    "MIT": _named("MIT License", "MIT licence", "MIT"),
    "Apache-2.0": _named("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache License v2", "Apache 2.0 License", "Apache 2.0", "Apache 2 License", "Apache Software License 2.0", "Apache Software License, Version 2.0"),
    "BSD-2-Clause": _named("BSD 2-Clause License", "BSD 2-Clause", "2-Clause BSD License", "2-Clause BSD", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": _named("BSD 3-Clause License", "BSD 3-Clause", "3-Clause BSD License", "3-Clause BSD", "New BSD License", "Modified BSD License", "Revised BSD License"),
    "ISC": _named("ISC License", "ISC licence", "ISC"),
    "MPL-1.1": _named("Mozilla Public License 1.1", "Mozilla Public License, Version 1.1", "MPL 1.1"),
    "MPL-2.0": _named("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPL v2.0", "MPLv2"),
    "EPL-1.0": _named("Eclipse Public License 1.0", "Eclipse Public License, Version 1.0", "Eclipse Public License v1.0", "Eclipse Public License - v 1.0", "EPL 1.0"),
    "EPL-2.0": _named("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0", "EPL 2.0"),
    "Unlicense": _named("Unlicense", "Unlicense License"),
    "CC0-1.0": _named("CC0 1.0", "CC0 1.0 Universal", "CC0", "Creative Commons Zero 1.0", "Creative Commons Zero v1.0 Universal"),
    "CC-BY-4.0": _creative("BY", "Attribution"),
    "CC-BY-SA-4.0": _creative("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC-4.0": _creative("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-ND-4.0": _creative("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _creative("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _creative("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    **_family("GPL", "General Public License", ["2.0", "3.0"]),
    **_family("LGPL", "Lesser General Public License", ["2.1", "3.0"]),
    **_family("AGPL", "Affero General Public License", ["3.0"]),
}
#: Names that are words of their own: only a licensing verb before them makes a notice.
BARE = {"MIT", "ISC"}
for _id, _forms in NAMES.items():
    _texts = [f"{lead}{x}" for x in _forms for lead in (("licensed under ", "released under ", "distributed under ") if x.split()[-1] in BARE else ("under ", "under the terms of ", "subject to the terms of "))]
    for _k, _text in enumerate([*_texts, f"SPDX-License-Identifier: {_id}"]):
        SENTENCES[f"{_id.lower()}-notice-{_k}"] = _text
        RULES.append((_id, (f"{_id.lower()}-notice-{_k}",)))
for _v in "23":
    for _k, _tail in enumerate(("or later", "or newer", "or any later version", "or (at your option) any later version")):
        SENTENCES[f"gpl-work-{_v}-later-{_k}"] = f"{SENTENCES[f'gpl-work-{_v}']} {_tail}"
        RULES.append((f"GPL-{_v}.0-or-later", (f"gpl-work-{_v}-later-{_k}",)))
for _short, _gnu, _v in (("GPL", "", "2"), ("GPL", "", "3"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3"), ("AGPL", "Affero ", "3")):
    _id, _spdx = f"{_short}-{_v}".lower(), f"{_short}-{_v if '.' in _v else _v + '.0'}"
    _may = f"you can redistribute it and/or modify it under the terms of the GNU {_gnu}General Public License as published by the Free Software Foundation"
    SENTENCES |= {f"{_id}-may-later": f"{_may}, either version {_v} of the License, or (at your option) any later version", f"{_id}-may-only": f"{_may}, version {_v} of the License", f"{_id}-may-only-plain": f"{_may}, version {_v}",
                  f"{_id}-may-plain-later": f"{_may}, either version {_v}, or (at your option) any later version", f"{_id}-may-only-later": f"{_may}, version {_v} of the License, or (at your option) any later version"}
    RULES += [(f"{_spdx}-or-later", (f"{_id}-may-later",)), (f"{_spdx}-or-later", (f"{_id}-may-plain-later",)), (f"{_spdx}-or-later", (f"{_id}-may-only-later",)), (f"{_spdx}-only", (f"{_id}-may-only",)), (f"{_spdx}-only", (f"{_id}-may-only-plain",))]
SENTENCES |= {
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense-public": "This is free and unencumbered software released into the public domain",
    "apache-title": "Apache License Version 2.0, January 2004",
    "gpl-title-2": "GNU General Public License Version 2, June 1991",
    "gpl-title-3": "GNU General Public License Version 3, 29 June 2007",
    "lgpl-title-2.1": "GNU Lesser General Public License Version 2.1, February 1999",
    "lgpl-title-3": "GNU Lesser General Public License Version 3, 29 June 2007",
    "agpl-title-3": "GNU Affero General Public License Version 3, 19 November 2007",
}
RULES += [
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-grant-and",)),
    ("Unlicense", ("unlicense-public",)),
    ("Apache-2.0", ("apache-notice-defined",)),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-2.0-only", ("gpl-title-2",)),
    ("GPL-3.0-only", ("gpl-title-3",)),
    ("LGPL-2.1-only", ("lgpl-title-2.1",)),
    ("LGPL-3.0-only", ("lgpl-title-3",)),
    ("AGPL-3.0-only", ("agpl-title-3",)),
    ("MIT", ("mit-grant",)),
    ("LicenseRef-BSD", ("bsd-redistribution",)),  # the sentence alone does not tell the clauses
]

_PLAIN = set("under the a terms of and conditions subject to version or later newer only any".split())
_WORD = re.compile(r"[A-Za-z0-9]+\+?")


def normal(text: str) -> tuple[str, ...]:
    return tuple(w.lower() for w in _WORD.findall(text))


class Rules:
    """The sentences as a trie of words and the rules, most sentences first."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, tuple[str, ...]]]):
        self.rules = sorted((r for r in rules if len(r[1]) > 1), key=lambda r: -len(r[1]))
        self.single: dict[str, str] = {}
        self.trie: dict = {}
        names: dict[str, str] = {}
        for name, text in sentences.items():
            node = self.trie
            for word in normal(text):
                node = node.setdefault(word, {})
            names[name] = node.setdefault(None, name)  # of sentences with the same words the first names them
        self.rules = [(licence, tuple(names.get(x, x) for x in wanted)) for licence, wanted in self.rules]
        for licence, wanted in rules:
            if len(wanted) == 1:
                self.single.setdefault(names.get(wanted[0], wanted[0]), licence)
        # every sentence holds its longest word that is not a plain one: a text without any of them has no sentence
        self.hint = "|".join(sorted({re.escape(max(normal(s), key=lambda w: (w not in _PLAIN, len(w)))) for s in sentences.values()}))

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """(identifier, start, end) of the sentences recognised, by position: from a word that starts one, the longest."""
        spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        found, i = [], 0
        while i < len(words):
            best, node, j = None, self.trie.get(words[i]), i
            while node is not None:
                if None in node:
                    best = (node[None], j)
                j += 1
                node = node.get(words[j]) if j < len(words) else None
            if best:
                found.append((best[0], spans[i][0], spans[best[1]][1]))
                i = best[1] + 1
            else:
                i += 1
        return found

    def licences(self, text: str) -> list[dict]:
        found = self.sentences(text)
        at: dict[str, list[int]] = {}
        for k, (name, _, _) in enumerate(found):
            at.setdefault(name, []).append(k)
        used, out = set(), []
        for licence, wanted in self.rules:
            if not all(name in at for name in wanted):
                continue
            begun: list[list[tuple[int, ...]]] = [[()], *([] for _ in wanted)]  # by length: the chains that wait for their next sentence
            for k in sorted({k for name in wanted for k in at[name]} - used):
                for n in range(len(wanted) - 1, -1, -1):
                    if wanted[n] == found[k][0] and begun[n]:
                        begun[n + 1].append((begun[n].pop() if n else ()) + (k,))
                        break
            for chain in begun[-1]:
                used.update(chain)
                out.append({"licence": licence, "sentences": [found[k][0] for k in chain], "start": found[chain[0]][1], "end": found[chain[-1]][2]})
        out += [{"licence": self.single[name], "sentences": [name], "start": start, "end": end} for k, (name, start, end) in enumerate(found) if k not in used and name in self.single]
        return sorted(out, key=lambda m: (m["start"], m["licence"]))


_MATCH = pa.struct([("licence", pa.string()), ("sentences", pa.list_(pa.string())), ("start", pa.int32()), ("end", pa.int32())])


def _scan(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            maybe = pc.fill_null(pc.match_substring_regex(texts, rules.hint, ignore_case=True), False).to_pylist()
            found = [rules.licences(texts[i].as_py()) if y else [] for i, y in enumerate(maybe)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_MATCH))], names=["doc", "matches"])

    return run


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """(doc_id, matches) of every row: the licences found with their sentence identifiers and span (code points), by position.

    Null and empty texts, and those without a known sentence, have no matches.  Of two rules of one length the first in the list wins.
    Repeated rows and null ids give a row each.  Texts are read whole.
    """
    r = Rules(sentences or SENTENCES, rules or RULES)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    out = arrow_map(rows, _scan(r), "doc long, matches array<struct<licence:string,sentences:array<string>,start:int,end:int>>")
    return out.withColumnRenamed("doc", "doc_id")
