"""License scans: winnowed template fingerprints pick candidates, banded alignment reports coverage and spans.

The templates are whole texts of short licenses and the customary notices of
long ones; pass ``templates`` for others. Their word n-grams are winnowed into
an inverted index; every n-gram of a document is looked up in it, hits of one
template near one diagonal form a candidate, and the candidate's stretch of the
document is aligned with the whole template in a band around that diagonal.

Words that tell licenses apart (families, variants and versions) decide: a match
holds if it has just the deciding words of its template, none fewer and no others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, table, with_row

WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
GRAM = 3
WINDOW = 3
BAND = 6
MIN_COVERAGE = 0.8

# Words that tell license families and variants apart.
DECIDING = frozenset("""
    affero agpl apache artistic boost bsd cc cc0 cddl eclipse epl gfdl gnu gpl isc lesser lgpl library mit mozilla mpl nc nd
    noncommercial noderivatives noderivs openssl public sa sharealike unlicense wtfpl zlib
""".split())
#: Whole numbers count as versions after these words only; elsewhere they number clauses.
VERSION = frozenset(["version", "v"])

# License texts and customary notices.
_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
          "(the \"Software\"), to deal in the Software without restriction")
_MIT = (_GRANT + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. ")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
          "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
          "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met")
_BSD_2 = (": Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
          "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
          "documentation and/or other materials provided with the distribution. ")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
          "this software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
            "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
            "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES")
TEMPLATES = {
    "Apache-2.0 (short)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                           "with the License. You may obtain a copy of the License at",
    "MIT (short)": "Released under the MIT License.",
    "MIT (licensed)": "Licensed under the MIT License.",
    "MIT (grant)": _GRANT,
    "MIT": _MIT + _AS_IS,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
           "the above copyright notice and this permission notice appear in all copies.",
    "BSD (conditions)": _BSD,
    "BSD-2-Clause": _BSD + _BSD_2 + _BSD_END,
    "BSD-3-Clause": _BSD + _BSD_2 + _BSD_3 + _BSD_END,
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
            "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
            "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "BSL-1.0 (short)": "Distributed under the Boost Software License, Version 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                 "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                 "non-commercial, and by any means.",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as "
             "long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "CC0-1.0 (short)": "Released under CC0 1.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL (header)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                    "License as published by the Free Software Foundation",
    "Proprietary": "All rights reserved. No part of this publication may be reproduced without prior written permission.",
    "All rights reserved": "All rights reserved.",
}
# By rule: the GNU family by version, Creative Commons by variant and version.
for _id, _name, _versions in (("GPL", "General", (2, 3)), ("LGPL", "Lesser General", (2.1, 3)), ("LGPL", "Library General", (2,)), ("AGPL", "Affero General", (3,))):
    for _v in _versions:
        TEMPLATES[f"{_id}-{float(_v)} (short)"] = f"This work is licensed under the GNU {_name} Public License, version {_v}."
        TEMPLATES[f"{_id}-{float(_v)}-or-later (header)"] = (
            f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {_name} Public License as published "
            f"by the Free Software Foundation, either version {_v} of the License, or (at your option) any later version.")
for _id, _name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                   ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v in ("3.0", "4.0"):
        _where = "Unported" if _v == "3.0" else "International"
        TEMPLATES[f"CC-{_id}-{_v} (short)"] = f"Licensed under CC {_id} {_v}."
        TEMPLATES[f"CC-{_id}-{_v}"] = f"This work is licensed under a Creative Commons {_name} {_v} {_where} License."
MATCH = "array<struct<license:string,matched:int,length:int,coverage:double,begin:long,end:long>>"


def winnow(hashes: list[int], window: int = WINDOW) -> set[int]:
    """Positions of the rightmost smallest hash of each window (of all, if there are fewer)."""
    picked = set()
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i:i + window]
        if part:
            least = min(part)
            picked.add(i + max(j for j, h in enumerate(part) if h == least))
    return picked


def decides(words: list[str], at: int) -> bool:
    """Whether the word tells licenses apart: a family or variant, or a version."""
    w = words[at]
    if w.isalpha():
        return w in DECIDING
    return not w.isdigit() or (at > 0 and words[at - 1] in VERSION)


def deciding(words: list[str]) -> Counter:
    return Counter(w for i, w in enumerate(words) if decides(words, i))


class Index:
    """Template words as numbers and the inverted index from winnowed n-grams to (template, position)."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.vocabulary: dict[str, int] = {}
        found = [WORD.findall(t.lower()) for t in templates.values()]
        self.words = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] for words in found]
        self.bags = [Counter(ids) for ids in self.words]
        self.deciding = [deciding(words) for words in found]
        self.postings: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.words):
            grams = [tuple(ids[i:i + GRAM]) for i in range(max(1, len(ids) - GRAM + 1))]
            mixed = [hash(g) & 0xFFFFFFFF for g in grams]  # hashes of integer tuples don't vary between processes
            for i in winnow(mixed):
                self.postings.setdefault(grams[i], []).append((t, i))

    def candidates(self, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Hits by template: (document position, diagonal), the diagonal being document minus template position."""
        if len(ids) < GRAM:
            return {}
        alien = np.concatenate(([0], np.cumsum(ids == 0)))
        out: dict[int, list[tuple[int, int]]] = {}
        for i in np.flatnonzero(alien[GRAM:] == alien[:-GRAM]).tolist():
            for t, p in self.postings.get(tuple(ids[i:i + GRAM].tolist()), ()):
                out.setdefault(t, []).append((i, i - p))
        return out

    def matches(self, words: list[str], ids: np.ndarray, min_coverage: float) -> list[tuple[int, int, int, int]]:
        """(template, matched words, first, last document word) of accepted alignments, most matched words first where they overlap.

        A hit is left out only if an accepted match of its template holds it, or if its diagonal was aligned
        since the last accepted match.
        """
        found = []
        for t, hits in self.candidates(ids).items():
            need, start, tried = min_coverage * len(self.words[t]), 0, set()
            for i, d in hits:
                if i < start or d in tried:
                    continue
                tried.add(d)
                low, high = max(start, d - BAND), max(0, d + len(self.words[t]) + BAND)
                stretch = ids[low:high].tolist()
                if (self.bags[t] & Counter(stretch)).total() < need:
                    continue  # an alignment has no more words than both have in common
                got = align(self.words[t], stretch, d - low)
                if got and got[0] >= need and deciding_at(words, low + got[1], low + got[2]) == self.deciding[t]:
                    found.append((t, got[0], low + got[1], low + got[2]))
                    start, tried = low + got[2] + 1, set()
        chosen: list[tuple[int, int, int, int]] = []
        for m in sorted(found, key=lambda m: (-m[1], m[2], m[0])):
            if all(m[3] < c[2] or m[2] > c[3] for c in chosen):
                chosen.append(m)
        return sorted(chosen, key=lambda m: m[2])


def deciding_at(words: list[str], first: int, last: int) -> Counter:
    return Counter(words[i] for i in range(first, last + 1) if decides(words, i))


def align(template: list[int], stretch: list[int], diagonal: int) -> tuple[int, int, int] | None:
    """Longest common subsequence of the template and a stretch of words within ``BAND`` words of the diagonal.

    Returns matched words and the first and last matched word of the stretch; of equal ones the shortest span, then the first.
    """
    row: dict[int, tuple[int, int]] = {}  # by word of the stretch: (matched, latest first word)
    none, top = (0, 0), None
    for i, w in enumerate(template):
        new, left = {}, none
        for j in range(max(0, diagonal + i - BAND), min(len(stretch), diagonal + i + BAND + 1)):
            best = max(left, row.get(j, none))
            if stretch[j] == w:
                m, first = row.get(j - 1, none)
                here = (m + 1, first if m else j)
                best = max(best, here)
                end = (here[0], here[1] - j, -here[1])
                top = end if top is None or end > top else top
            new[j] = left = best
        row = new
    return (top[0], -top[2], -top[2] - top[1]) if top else None


def scan(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """License notices in every row of ``docs(doc_id, text)``, whole texts: ``__llm_row, doc_id, matches``.

    A match has the template's name and length in words, matched words, coverage, and the character
    range from the first to the last matched word; matches of a document don't overlap: the one with
    more matched words counts, of equal ones the first in the text, then in ``templates``. Null or
    empty text has none; repeated rows give a row each, very long texts are read whole, an empty
    table gives no rows, and other columns are left out whatever they are called.
    """
    index = Index(TEMPLATES if templates is None else templates)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.vocabulary.get
        for batch in batches:
            out = []
            for text in batch.column(2):
                text = (text.as_py() or "").lower()
                got = WORD.findall(text)
                hits = index.matches(got, np.fromiter((number(w, 0) for w in got), np.int64, len(got)), min_coverage)
                places = [m.span() for m in WORD.finditer(text)] if hits else []
                out.append([{"license": index.names[t], "matched": m, "length": len(index.words[t]), "coverage": m / len(index.words[t]),
                             "begin": places[a][0], "end": places[b][1]} for t, m, a, b in hits])
            kind = pa.list_(pa.struct([("license", pa.string()), ("matched", pa.int32()), ("length", pa.int32()), ("coverage", pa.float64()),
                                       ("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], [ROW, "doc_id", "matches"])

    rows = with_row(docs.select("doc_id", F.col("text").cast("string").alias("text"))).select(ROW, "doc_id", "text")
    return rows.mapInArrow(look, f"{ROW} long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, matches {MATCH}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document all its notices (``matches``, in text order, with spans), their number and names, lowest coverage and first span."""
    found = scan(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join("matches.license", ";").alias("licenses"),
                        F.array_min("matches.coverage").alias("least_coverage"),
                        F.try_element_at("matches.begin", F.lit(1)).alias("first_begin"),
                        F.try_element_at("matches.end", F.lit(1)).alias("first_end"), "matches")
