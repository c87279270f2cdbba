"""Language identification by word-first backoff.

A word seen in training scores by its log frequency in each language; an unseen
word falls back to its longest character n-grams that were seen (5 down to 1).
Counts cover every training document and every distinct word of the corpus is
scored once. Document scores are sums over words: the most frequent words are
added up in the scan from a broadcast table of at most ``HOT_CELLS`` numbers,
all other words by a join on the word, so neither the vocabulary nor the
n-grams are ever held whole in one place.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, own_names, small_batches, table, with_row
from contrail.session import materialize

LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 5
SMOOTHING = 0.1
#: Bound of the broadcast table: words times languages.
HOT_CELLS = 600_000
#: A task hands over its word counts when it holds this many.
FLUSH = 200_000
UNKNOWN = "und"


def tokens(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return LETTERS.findall(text.lower())


def has_letter(text: str | None) -> bool:
    return text is not None and any(any(map(str.isalpha, m.group())) for m in LETTERS.finditer(text))


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text mod 4 is 2; false for a null id (which is not learned from either)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, lang, n) over every document; ``lang`` is null for words of documents not learned from."""
    learn = F.when(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")), F.col("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}

        def out() -> pa.RecordBatch:
            columns = [(chain.from_iterable(held.values()), pa.string()),
                       (chain.from_iterable(repeat(lang, len(c)) for lang, c in held.items()), pa.string()),
                       (chain.from_iterable(c.values() for c in held.values()), pa.int64())]
            batch = pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns], ["word", "lang", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py()
                if text:
                    held.setdefault(lang, Counter()).update(tokens(text))
                    if sum(map(len, held.values())) > FLUSH:
                        yield out()
        yield out()

    rows = docs.select(F.col("text").cast("string").alias("text"), learn.cast("string").alias("lang"))
    return rows.mapInArrow(count, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def grams(word, size: int):
    """Character n-grams of a word with its edges marked."""
    edged = F.concat(F.lit("_"), word, F.lit("_"))
    return F.when(F.length(edged) >= size,
                  F.transform(F.sequence(F.lit(1), F.length(edged) - size + 1), lambda i: F.substring(edged, i, F.lit(size))))


def scored_words(spark: SparkSession, counts: DataFrame, langs: list[str]) -> DataFrame:
    """(word, n, score array<double> by language) for every word in ``counts``."""
    per = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)) for lang in langs]
    words = counts.groupBy("word").agg(F.sum("n").alias("n"), F.array(*per).alias("c"))
    words = words.withColumn("known", F.expr("exists(c, x -> x > 0)")).withColumn("id", F.monotonically_increasing_id())
    words = materialize(spark, words, "lang-words")
    known, left = words.where("known"), words.where("not known").select("id", "word", "n")
    flat = F.array(*[F.sum(F.col("c")[i]) for i in range(len(langs))])

    def with_logs(df: DataFrame) -> DataFrame:
        """Smoothed log frequencies of the counts ``c`` among all of ``df``."""
        row = df.agg(F.count("*").alias("kinds"), flat.alias("c")).first()
        return df.withColumn("score", F.array(*[F.log((F.col("c")[i] + SMOOTHING) / F.lit((row.c[i] or 0) + SMOOTHING * max(1, row.kinds)))
                                                for i in range(len(langs))]))

    scored = [with_logs(known).select("word", "n", "score")]
    # longest n-grams first: a word goes on to the next shorter ones only if none of its n-grams was seen
    for size in range(LONGEST, 0, -1):
        seen = known.select(F.explode(grams(F.col("word"), size)).alias("gram"), "c").groupBy("gram").agg(flat.alias("c"))
        seen = with_logs(materialize(spark, seen, "lang-grams")).select("gram", "score")
        pieces = left.select("id", F.explode(grams(F.col("word"), size)).alias("gram"))
        mean = F.array(*[F.avg(F.col("score")[i]) for i in range(len(langs))])
        found = pieces.join(seen, "gram").groupBy("id").agg(mean.alias("score"))
        both = materialize(spark, left.join(found, "id", "left"), "lang-backoff")
        scored.append(both.where("score is not null").select("word", "n", "score"))
        left = both.where("score is null").select("id", "word", "n")
    out = left.select("word", "n", F.array(*[F.lit(0.0)] * len(langs)).alias("score"))  # nothing of it was seen
    for part in scored:
        out = out.unionByName(part)
    return out


def hot_cut(scores: DataFrame, most: int) -> int:
    """Smallest count such that at most ``most`` words occur that often or more."""
    steps = scores.groupBy("n").count().orderBy(F.desc("n"))
    total, cut = 0, None
    for r in steps.toLocalIterator():
        total += r["count"]
        if total > most:
            break
        cut = r["n"]
    return cut if cut is not None else (1 << 62)


def identify(spark: SparkSession, docs: DataFrame, hot_cells: int = HOT_CELLS) -> DataFrame:
    """Language of every row of ``docs(doc_id, text, lang)``; whole texts, one row out per row in.

    Learns from the text and non-null ``lang`` of documents that are not held out.
    Columns ``__llm_row, doc_id, held_out, lang_pred, score``: ``score`` is the posterior of the
    predicted language under equal priors. Text that is null or has no letter, and every text
    if nothing could be learned, is ``und`` with score 0; ties go to the first language by name.
    """
    rows = with_row(docs.select("doc_id", "text", "lang")).select(
        ROW, "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    with small_batches(spark):
        counts = materialize(spark, word_counts(docs), "lang-counts")
    langs = sorted(r.lang for r in counts.where("lang is not null").select("lang").distinct().collect())
    if not langs:
        return rows.select(ROW, "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    scores = scored_words(spark, counts, langs)
    cut = hot_cut(scores, hot_cells // len(langs))
    hot = scores.where(F.col("n") >= cut).select("word", "score").toArrow().combine_chunks()
    matrix = hot["score"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs))
    shared = spark.sparkContext.broadcast(({w: i for i, w in enumerate(hot["word"].to_pylist())}, matrix))
    del hot, matrix

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = shared.value
        for batch in batches:
            letters, sums, rest, times = [], [], [], []
            for text in batch.column(3):
                text = text.as_py()
                counted = Counter(tokens(text)) if text else Counter()
                at = [(place[w], n) for w, n in counted.items() if w in place]
                total = np.zeros(values.shape[1])
                if at:
                    idx, n = np.array(at).T
                    total = n @ values[idx]
                cold = {w: n for w, n in counted.items() if w not in place}
                letters.append(has_letter(text))  # a known token may be a letterless number sign
                sums.append(total.tolist())
                rest.append(list(cold))
                times.append(list(cold.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(letters, pa.bool_()), pa.array(sums, pa.list_(pa.float64())),
                 pa.array(rest, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
                [ROW, "doc_id", "held_out", "letters", "sums", "words", "times"])

    ident = rows.schema["doc_id"].dataType.simpleString()
    with small_batches(spark):
        partly = materialize(spark, rows.mapInArrow(
            add_up, f"{ROW} long, doc_id {ident}, held_out boolean, letters boolean, sums array<double>, words array<string>, times array<long>"),
            "lang-docs")
    cold = partly.select(ROW, F.explode(F.arrays_zip("words", "times")).alias("w")).select(ROW, F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    tail = scores.where(F.col("n") < cut).select("word", "score")
    cold = cold.join(tail, "word").groupBy(ROW).agg(F.array(*[F.sum(F.col("score")[i] * F.col("n")) for i in range(len(langs))]).alias("more"))
    total = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    best = F.array_max("total")
    posterior = 1 / F.aggregate(F.transform("total", lambda x: F.exp(x - best)), F.lit(0.0), lambda a, x: a + x)
    return (
        partly.drop("words", "times").join(cold, ROW, "left").withColumn("total", total)
        .select(ROW, "doc_id", "held_out",
                F.when(F.col("letters"), F.element_at(F.array(*map(F.lit, langs)), F.array_position("total", best).cast("int")))
                .otherwise(UNKNOWN).alias("lang_pred"),
                F.when(F.col("letters"), posterior).otherwise(0.0).alias("score"))
    )


@own_names
def identified_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language cannot be told (``und``)."""
    rejected = identify(spark, docs).where(F.col("lang_pred") == UNKNOWN).select(F.col(ROW).alias("__rejected"))
    rows = with_row(docs)
    rejected = materialize(spark, rejected, "lang-rejected")
    return rows.join(rejected, rows[ROW] == rejected["__rejected"], "left_anti").select(*[rows[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "documents")).drop(ROW)
