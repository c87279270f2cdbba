"""Texts reach Python in batches of bounded size."""

from contrail.llm import langid
from contrail.llm.common import BATCH_ROWS, BATCHES, small_batches
from contrail.session import materialize


def test_language_reads_texts_in_small_batches(spark, monkeypatch):
    seen = {}

    def noted(spark, df, name):
        seen[name] = {k: spark.conf.get(k, None) for k in BATCHES}
        return materialize(spark, df, name)

    monkeypatch.setattr(langid, "materialize", noted)
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    docs = materialize(spark, spark.createDataFrame([(1, "ein kurzer Satz", "de"), (2, "a short one", "en"), (3, None, None), (4, "ein a", None)],
                                                    "doc_id long, text string, lang string"), "docs")
    assert {r.doc_id for r in langid.identify(spark, docs).collect()} == {1, 2, 3, 4}
    assert seen["lang-counts"] == seen["lang-docs"] == {k: str(v) for k, v in BATCHES.items()}
    assert {k: spark.conf.get(k, None) for k in BATCHES} == before


def test_smaller_batches_that_are_set_stay(spark):
    rows = next(iter(BATCHES))
    before = spark.conf.get(rows)
    try:
        for held, inside in (("7", "7"), ("0", str(BATCH_ROWS)), ("90000", str(BATCH_ROWS))):
            spark.conf.set(rows, held)
            with small_batches(spark):
                assert spark.conf.get(rows) == inside
            assert spark.conf.get(rows) == held
    finally:
        spark.conf.set(rows, before)
