"""License scans: names of near alike licenses, every occurrence, spans, and alignments against all subsequences."""

import itertools
import random

import numpy as np
import pytest

from contrail.llm import licenses
from contrail.llm.licenses import BAND, TEMPLATES, Index, align


@pytest.fixture(scope="module")
def index():
    return Index(TEMPLATES)


def found(index, text):
    words = licenses.WORD.findall(text.lower())

    ids = np.array([index.vocabulary.get(w, 0) for w in words], np.int64)
    return [(index.names[t], words[a:b + 1]) for t, _, a, b in index.matches(words, ids, licenses.MIN_COVERAGE)]


def test_every_template_names_itself(index):
    for name, text in TEMPLATES.items():
        assert [n for n, _ in found(index, f"foo 12 {text} bar 3")] == [name]


@pytest.mark.parametrize("text, names", [
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0 (short)"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0 (short)"]),
    ("This work is licensed under the GNU General Public License, version 7. There are 3 more.", []),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0 (short)"]),
    ("Licensed under CC BY-NC-ND 3.0", ["CC-BY-NC-ND-3.0 (short)"]),
    ("All rights reserved.", ["All rights reserved"]),
    ("All rights were reserved.", []),
    ("Released under the MIT License. Released under the MIT License.", ["MIT (short)"] * 2),
    ("Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0.",
     ["CC-BY-4.0 (short)", "CC-BY-SA-4.0 (short)", "CC-BY-4.0 (short)"]),
    ("1. " + TEMPLATES["BSD-3-Clause"].replace("Redistributions in", "2. Redistributions in").replace("Neither", "3. Neither"), ["BSD-3-Clause"]),
    (TEMPLATES["MIT"].replace("Software", "Program"), ["MIT"]),
])
def test_names_and_occurrences(index, text, names):
    assert [n for n, _ in found(index, text)] == names


def test_notice_inside_a_long_text_is_cut_tightly(index):
    text = "licensed to all, licensed under nothing " * 3000 + "licensed under the apache license, version 2.0 and " + "license " * 5000
    assert found(index, text) == [("Apache-2.0 (short)", "licensed under the apache license version 2.0".split())]


def longest(template, stretch, diagonal):
    """Most words of a common subsequence within the band, by trying all subsequences of the template, and its shortest span."""
    for size in range(len(template), 0, -1):
        best = None
        for picked in itertools.combinations(range(len(template)), size):
            ends = {}  # latest first word by last word
            for n, i in enumerate(picked):
                new = {}
                for j in range(max(0, diagonal + i - BAND), min(len(stretch), diagonal + i + BAND + 1)):
                    if stretch[j] == template[i]:
                        first = j if n == 0 else max((f for e, f in ends.items() if e < j), default=None)
                        if first is not None:
                            new[j] = first
                ends = new
            for last, first in ends.items():
                key = (last - first, first)
                best = key if best is None or key < best else best
        if best:
            return size, best[1], best[1] + best[0]
    return None


def test_alignment_against_all_subsequences():
    rng = random.Random(7)
    for _ in range(300):
        template = [rng.randint(1, 3) for _ in range(rng.randint(1, 7))]
        stretch = [rng.randint(0, 3) for _ in range(rng.randint(0, 12))]
        diagonal = rng.randint(-3, 6)
        assert align(template, stretch, diagonal) == longest(template, stretch, diagonal)


def test_scan_keeps_every_row_and_reports_all_matches(spark):
    notice = "Released under the MIT License."
    rows = [(1, None, 5), (2, "", 5), (3, f"{notice} x {notice}", 5), (3, f"{notice} x {notice}", 5), (4, "Ünïcode ² ½ " * 50 + notice, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches int")
    got = sorted((r.doc_id, [(m.license, m.begin, m.end) for m in r.matches]) for r in licenses.scan(spark, docs).collect())
    twice = [("MIT (short)", 0, 30), ("MIT (short)", 34, 64)]
    assert got == [(1, []), (2, []), (3, twice), (3, twice), (4, [("MIT (short)", 600, 630)])]
    assert licenses.scan(spark, docs.limit(0)).collect() == []
