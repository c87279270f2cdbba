"""The hashed maximum-entropy model: exact counts, probabilities that sum to one, and what it learns."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import maxent
from tests.conftest import SF001, SF01

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ROWS = [(i, t) for i, t in enumerate(["the cat sat", "The CAT sat on\tthe mat\n", None, "", " \x0b ", "É é \x85\xa0x 日本 \x1f \x00z", "a " * 3000, "unheard of words here",
                                      "the the the", "x" * 300_000 + " tail", "one\r\ntwo", "the cat sat"])] + [(None, "the null id"), (3, "the twin"), (3, "the twin")]


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + ["\n"]


def expected(rows):
    """Sorted (doc_id, held_out, n_tokens, n_known, train_tokens, base) by plain counting."""
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if i is not None and not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted((i if i is not None else -1, out(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)


def counted(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("token", "n", "own", "base", "seen", "part", "score")})


@pytest.mark.parametrize("hot", [maxent.HOT, 2])
def test_counts_and_base(spark, odd, hot):
    assert counted(maxent.score(spark, odd, hot=hot)) == expected(ROWS)


def test_scores_do_not_depend_on_the_table_of_frequent_tokens(spark, odd):
    a, b = (sorted((str(r.doc_id), r.score) for r in maxent.score(spark, odd, hot=h).collect()) for h in (maxent.HOT, 3))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([x for _, x in a], [x for _, x in b], atol=1e-5)
    assert all(x < 0 and math.isfinite(x) for _, x in a)


def test_no_rows_and_nothing_to_learn_from(spark, odd):
    assert maxent.score(spark, odd.limit(0)).count() == 0
    rows = maxent.score(spark, odd.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(rows) == len(ROWS) and all(r.n_known == 0 and r.base_score == 0 and r.train_tokens == 0 and r.score < 0 for r in rows)


def test_counts_of_the_small_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = maxent.query(spark, SF001)
    assert counted(got) == expected(docs)
    assert got.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_beats_the_base_on_documents_not_learned_from(spark):
    rows = maxent.query(spark, SF01).where("held_out").collect()
    assert sum(r.score > r.base_score for r in rows) > 0.8 * len(rows)
    assert sum(r.score for r in rows) > 0.985 * sum(r.base_score for r in rows)


def model_of(text, times=1):
    """Items and a model that one learner made of a text's tokens, walked ``times`` times."""
    c = Counter(text.split())
    top = sorted(c, key=lambda t: t[::-1])[:maxent.WORDS - 1]
    h = maxent.numbers_of(top)[0]
    mass = np.zeros(maxent.CLASSES * maxent.MEMBERS, np.int64)
    mass[0], mass[1:len(top) + 1], mass[maxent.WORDS:] = 1, [c[t] for t in top], 1
    order = np.argsort(h)
    items = maxent.Items(h[order], np.arange(1, len(top) + 1)[order], mass)
    learner = maxent.Learner(maxent.untrained(mass))
    for _ in range(times):
        s = maxent.stream(next(maxent.pieces([text], 1 << 20)), items)
        learner.learn(maxent.History().features(s.item, s.hash))
        learner.update()
    return items, learner.model._replace(outer=learner.outer.weights, inner=learner.inner.weights), {t: i for i, t in enumerate(top, 1)}


def test_probabilities_sum_to_one_after_every_history():
    items, model, _ = model_of(b"a b c a b d a b e f g " * 40, times=5)
    every = np.flatnonzero(items.mass)
    scorer = maxent.Scorer(model)
    rng = np.random.default_rng(3)
    for _ in range(5):
        before = rng.choice(every, 2)
        hashed = rng.integers(0, 1 << 63, 2).astype(np.uint64)
        got = []
        for i in every:
            b = maxent.History().features(np.append(before, i), np.append(hashed, np.uint64(1)))
            got.append(scorer.log_probabilities(b.part(slice(2, 3)))[0])
        assert abs(sum(10.0 ** x for x in got) - 1) < 1e-4


def test_learns_order_and_skips():
    items, model, number = model_of(b"red x1 fox red x2 fox red x3 fox blue x1 dog blue x2 dog blue x3 dog " * 60, times=60)
    scorer = maxent.Scorer(model)

    def p(text, word):
        s = maxent.stream(next(maxent.pieces([text], 1 << 20)), items)
        b = maxent.History().features(s.item, s.hash)
        at = len(text.split()) - 1
        assert s.item[at] == number[word]
        return 10 ** scorer.log_probabilities(b.part(slice(at, at + 1)))[0]

    # the word two back decides: a skip feature, since the last word tells nothing
    assert p(b"fox red x1 fox", b"fox") > 0.8 and p(b"dog blue x1 dog", b"dog") > 0.8 and p(b"fox red x1 dog", b"dog") < 0.1


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_pieces_are_one_stream(size):
    texts = [b"a bb ccc", b"", b" \t", b"dd" * 40 + b" e", b"one two\nthree four five", b"tail "]
    items = maxent.Items(maxent.numbers_of([b"bb"])[0], np.array([5]), np.ones(maxent.CLASSES * maxent.MEMBERS, np.int64))
    whole = [maxent.stream(p, items) for p in maxent.pieces(texts, 1 << 20)]
    cut = [maxent.stream(p, items) for p in maxent.pieces(texts, size)]
    for f in ("hash", "item", "doc"):
        assert np.array_equal(np.concatenate([getattr(s, f) for s in whole]), np.concatenate([getattr(s, f) for s in cut]))
    assert [s.data[a:b] for s in cut for a, b in zip(s.begin, s.end)] == [w for t in texts for w in t.split()]
    history, at_once = maxent.History(), maxent.History().features(whole[0].item, whole[0].hash)
    parts = [history.features(s.item, s.hash) for s in cut if len(s.item)]
    assert np.array_equal(np.concatenate([b.outer for b in parts], axis=1), at_once.outer)


def test_changes_are_averaged_by_count():
    import pandas as pd
    wide = maxent.CLASSES

    def change(rows, counts, value):
        return (0, 0, 1, np.array(rows, np.uint16).tobytes(), np.array(counts, np.int64).tobytes(), np.full((len(rows), wide), value, np.float16).tobytes())

    got = maxent.add_changes(pd.DataFrame([change([64, 66], [3, 1], 1.0), change([64], [1], 5.0)], columns=["part", "which", "block", "rows", "counts", "steps"])).iloc[0]
    assert np.frombuffer(got["rows"], np.uint16).tolist() == [64, 66] and np.frombuffer(got["counts"], np.int64).tolist() == [4, 1]
    assert np.frombuffer(got["steps"], np.float16).reshape(2, wide)[:, 0].tolist() == [2.0, 1.0]


def test_frequent_tokens_are_found_and_no_others():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(1, 1 << 63, 5000).astype(np.uint64))
    rng.shuffle(hashes)
    table = maxent.Frequent(hashes[:2500], np.arange(1.0, 2501))
    hit, value = table.find(hashes)
    assert not hit[2500:].any() and not value[2500:].any() and hit[:2500].mean() > 0.9
    assert np.array_equal(value[:2500][hit[:2500]], np.arange(1.0, 2501)[hit[:2500]])
    assert not maxent.Frequent(hashes[:0], np.zeros(0)).find(hashes)[0].any()


def test_hashes_of_words_of_all_lengths():
    words = [bytes([97 + i % 26]) * n for n in (1, 3, 4, 5, 8, 9, 16, 17, 255, 256, 257, 9000) for i in range(20)]
    alone = [maxent.numbers_of([w]) for w in words]
    together = maxent.numbers_of(words)
    assert len(set(together[0].tolist())) == len(set(words)) and np.array_equal(together[0], np.concatenate([a for a, _ in alone]))
    assert np.array_equal(together[1], np.concatenate([b for _, b in alone])) and together[1].max() < maxent.BINS
    assert maxent.numbers_of([b"station"])[1] == maxent.numbers_of([b"relation"])[1]
