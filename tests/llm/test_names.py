"""Input columns that are called like the operators' own, and tokens without letters."""

import pytest
from pyspark.sql import functions as F

from contrail.llm import decontam, jaccard, langid, mixing, suffix

TEXTS = [(1, "the quick brown fox jumps over the lazy dog while seven wizards quietly boxed five dozen liquor jugs", "en"),
         (2, "the quick brown fox jumps over the lazy dog while seven wizards quietly boxed five dozen liquor jugs", "en"),
         (3, "le chat noir dort sur la chaise pendant que la pluie tombe sur le toit de la maison", "fr"), (4, None, None)]


@pytest.mark.parametrize("run", [
    langid.identified_documents, jaccard.distinct_documents, suffix.deduplicated_documents, mixing.mixed_documents,
    lambda spark, docs: decontam.decontaminate(spark, docs, spark.createDataFrame([(1, "chat noir dort")], "item_id long, text string"))])
def test_columns_called_like_the_operators_own(spark, tmp_dir, run):
    names = ("__llm_row", "__hit", "__gone", "__taken", "__rejected", "__c0", "aside_0")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs = docs.withColumns({c: F.col("doc_id") * 100 + i for i, c in enumerate(names)})
    docs.write.parquet(f"{tmp_dir}/d")
    docs = spark.read.parquet(f"{tmp_dir}/d")
    out = run(spark, docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == r.doc_id * 100 + i for r in rows for i, c in enumerate(names))


@pytest.mark.parametrize("cells", [langid.HOT_CELLS, 2, 0])
def test_tokens_without_letters_have_no_language(spark, cells):
    learned = [(i, "² ½ the house and the garden ² ½", "en") for i in range(20)] + [(i, "le jardin et la maison ²", "fr") for i in range(20, 40)]
    docs = spark.createDataFrame(learned + [(100, "²", None), (101, "½ 12 ½", None), (102, "½ the", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spark, docs, hot_cells=cells).collect()}
    assert got[100] == got[101] == ("und", 0.0) and got[102][0] == "en"
