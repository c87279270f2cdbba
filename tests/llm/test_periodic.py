"""Periodic runs against a search over all lags and starts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from contrail.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, runs string, best int"  # two names that the operator uses itself


def all_runs(words):
    """Every maximal stretch of smallest period q and max(6, 4q) words at least."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            least = not any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and least:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = all_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id or -1, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def rows_of(df):
    return sorted((r.doc_id or -1, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in df.collect())


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_small_alphabets(seed):
    r = random.Random(seed)
    words = [r.randrange(1 + seed % 4) for _ in range(r.randrange(90))]
    for _ in range(seed % 3):  # longer periods, nested ones included
        at, q = r.randrange(len(words) + 1), r.randrange(1, 25)
        words[at:at] = [r.randrange(3) for _ in range(q)] * r.randrange(3, 7)
    assert periodic.runs(np.array(words, np.int64)) == all_runs(words)


def test_runs_of_long_periods():
    r = random.Random(5)
    words = [r.randrange(1000) for _ in range(300)]
    root = [r.randrange(1000) for _ in range(173)]
    long = words + root * 4 + root[:50] + words + [7] * 5000 + [1, 2, 3] * 999 + words
    found = periodic.runs(np.array(long, np.int64))
    assert (300, 173 * 4 + 50, 173) in found and [f[1:] for f in found if f[2] == 1] == [(5000, 1)] and len(found) == 3
    assert periodic.runs(np.array(words + root * 3 + words, np.int64)) == []  # three and a bit periods are too few


def test_overlapping_runs_each_keep_their_first_period():
    words = [b"a"] * 6 + [b"b", b"a"] * 5
    found = periodic.runs(periodic.numbered(words))
    assert found == all_runs(words) == [(0, 6, 1), (5, 11, 2)]
    assert periodic.kept_words(words, found) == [b"a", b"b"]  # the sixth a is in the first run's repeats, the first b in no repeat


def test_query_on_odd_rows(spark, tmp_dir):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:20] + list(range(1, 12))
    texts = ["", None, " \t\n ", "one", "a b c d e f g h i j k l m n o p q r s t", "x " * 50, "The the THE the " * 9, "é è é è é è é è\x0b9\x00 9 ü",
             " ".join(f"w{i % 37}" for i in range(1500)), " ".join(f"u{i}" for i in range(3000)), "p q r " * 4 + "p q r s " * 5 + "tail"]
    rows = [(i, t, "x", 1) for k, i in enumerate(ids) for t in (texts[k % len(texts)],)] + [(None, "a " * 9, None, None), (5, "z " * 7, "", 2), (5, "z " * 7, "", 2)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    assert rows_of(periodic.query(spark, tmp_dir)) == sorted(expected(i, t) for i, t, *_ in rows)
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_dir}/none/documents.parquet")
    assert periodic.query(spark, f"{tmp_dir}/none").count() == 0


def test_query_on_the_small_table(spark):
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(periodic.query(spark, SF001)) == sorted(expected(*d) for d in docs)


def test_collapsed_text(spark):
    docs = spark.createDataFrame([(3, "start no no no no no no no end")], "doc_id long, text string")
    row = periodic.periodic_runs(spark, docs).first()
    assert row.collapsed == "start no end" and [tuple(r) for r in row.runs] == [(1, 7, 1)]
