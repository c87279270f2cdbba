"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training windows.

Words are runs of ASCII letters and digits (lower-cased) and non-ASCII
characters. A window is ``window`` consecutive words of an item; an item of
fewer words is one window. A document word inside any occurrence of a window
is hit.

The broadcast set holds at most ``max_windows`` (window, item) pairs: a larger
benchmark is split by the digest of the window text into blocks of at most that
many, each scanned in its own pass, and the hits of the passes are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, carry, own_names, table, with_row
from contrail.session import materialize

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
#: Bound of one broadcast set, in (window, item) pairs: some 50 MB on the driver and in each worker.
MAX_WINDOWS = 100_000
SPAN = "array<struct<first:int,last:int,begin:long,end:long>>"


def words(text: bytes | None) -> list[bytes]:
    """Normalised words of UTF-8 bytes (``bytes.lower`` changes A-Z only)."""
    return WORD.findall(text.lower()) if text else []


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (window, item) pairs of ``benchmark(item_id, text)``; ``window`` joins words by spaces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, items = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = words(text)
                size = min(window, len(got))
                seen = {b" ".join(got[i:i + size]) for i in range(len(got) - size + 1)} if got else ()
                grams += seen
                items += [item] * len(seen)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(items, pa.string())], ["gram", "item"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, "gram binary, item string").distinct()


def gram_set(pairs: list[tuple[bytes, str | None]]) -> tuple[dict, dict]:
    """Word numbers, and the windows of one block as word-number arrays by length with their items: the exact set hits are verified in."""
    vocabulary: dict[bytes, int] = {}
    items: dict[int, dict[bytes, list[str]]] = {}
    for gram, item in pairs:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in gram.split(b" ")], np.uint32)
        items.setdefault(len(ids), {}).setdefault(ids.tobytes(), []).append("null" if item is None else item)
    return vocabulary, items


def hits(known: tuple[dict, dict], got: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged hit spans [first, last] in words, and the items with an occurring window."""
    vocabulary, items = known
    number = vocabulary.get
    ids = np.fromiter((number(w, 0) for w in got), np.uint32, len(got))
    alien = np.concatenate(([0], np.cumsum(ids == 0)))
    spans, by = [], set()
    for size, grams in items.items():
        if len(ids) < size:
            continue
        for i in np.flatnonzero(alien[size:] == alien[:-size]).tolist():
            found = grams.get(ids[i:i + size].tobytes())
            if found is not None:
                spans.append((i, i + size - 1))
                by.update(found)
    return merge(spans), by


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of inclusive spans, touching ones joined."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def bounds(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Word spans with the byte range from the first word's begin to the last word's end."""
    if not spans:
        return []
    places = [m.span() for m in WORD.finditer(text.lower())]
    return [{"first": a, "last": b, "begin": places[a][0], "end": places[b][1]} for a, b in spans]


def scan(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Hits of every row of ``docs(doc_id, text)``, whole texts.

    Columns ``__llm_row, doc_id, n_words, spans`` (word and byte ranges, in order, not touching)
    ``, items`` (item ids as strings, sorted, distinct; a null id is the string ``null``).
    Null or word-less texts and an empty benchmark give no hits; repeated rows give a row each.
    """
    pairs = materialize(spark, item_windows(benchmark, window), "benchmark-windows")
    total = pairs.count()
    blocks = 1 if total <= max_windows else -(-2 * total // max_windows)
    rows = with_row(docs.select("doc_id", "text")).select(ROW, "doc_id", F.col("text").cast("binary").alias("text"))
    ident = [f.dataType.simpleString() for f in rows.schema.fields[:2]]
    found = None
    for block in range(blocks):
        part = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == block)
        held = [(bytes(r.gram), r.item) for r in part.toLocalIterator()]
        grams = spark.sparkContext.broadcast(gram_set(held))

        def look(batches: Iterator[pa.RecordBatch], grams=grams) -> Iterator[pa.RecordBatch]:
            known = grams.value
            for batch in batches:
                counts, spans, items = [], [], []
                for text in batch.column(2):
                    text = text.as_py()
                    got = words(text)
                    hit, by = hits(known, got)
                    counts.append(len(got))
                    spans.append(bounds(text, hit))
                    items.append(sorted(by))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())]))),
                     pa.array(items, pa.list_(pa.string()))], [ROW, "doc_id", "n_words", "spans", "items"])

        one = rows.mapInArrow(look, f"{ROW} {ident[0]}, doc_id {ident[1]}, n_words long, spans {SPAN}, items array<string>")
        found = one if found is None else found.unionByName(one)
    if blocks == 1:
        return found
    # one row per row and pass: put the spans of a row together
    grouped = found.groupBy(ROW).agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                     F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.expr("""aggregate(spans, cast(array() as array<struct<first:int,last:int,begin:long,end:long>>), (acc, s) ->
        if(size(acc) > 0 and s.first <= element_at(acc, -1).last + 1,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first, 'last', greatest(element_at(acc, -1).last, s.last),
                  'begin', element_at(acc, -1).begin, 'end', greatest(element_at(acc, -1).end, s.end)))),
           concat(acc, array(s))))""")
    return grouped.withColumn("spans", joined)


@own_names
def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the hit spans: their bytes go, ``n_chars`` is counted anew, a document left without words goes.

    Columns and clean rows stay as they are.
    """
    spans = scan(spark, docs, benchmark, **options).where(F.size("spans") > 0).select(F.col(ROW).alias("__hit"), "n_words", "spans")
    spans = materialize(spark, spans, "benchmark-hits")  # written: its size decides the join, and few hits move no text
    rows = with_row(docs)
    text = rows["text"].cast("binary")
    cut = F.expr("""aggregate(spans, named_struct('at', 1L, 'kept', cast('' as binary)),
        (acc, s) -> named_struct('at', s.end + 1, 'kept', concat(acc.kept, substring(__text, cast(acc.at as int), cast(s.begin + 1 - acc.at as int)))),
        acc -> concat(acc.kept, substring(__text, cast(acc.at as int))))""")
    kept, back = carry(rows, (ROW,))
    hit_words = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    out = rows.select(ROW, *kept, text.alias("__text")).join(spans, F.col(ROW) == F.col("__hit"), "left")
    out = out.where(F.col("__hit").isNull() | (hit_words < F.col("n_words"))).withColumn("__cut", F.when(F.col("__hit").isNotNull(), cut.cast("string")))

    def final(safe: str, name: str):
        if name == "text":
            return F.coalesce(F.col("__cut"), F.col(safe)).alias(name)
        if name == "n_chars":
            return F.when(F.col("__cut").isNull(), F.col(safe)).otherwise(F.length("__cut").cast(docs.schema[name].dataType)).alias(name)
        return F.col(safe).alias(name)

    return out.select(*[final(s, c) for s, c in back.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = scan(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, g FROM (
         SELECT item, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
                for i in range(1, len(w) - least(len(w), 10) + 2)]) AS g FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, unnest([struct_pack(i := i, g := array_to_string(w[i:i + n - 1], ' ')) for i in range(1, len(w) - n + 2)]) AS s
       FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT dw.r, dw.n, dw.s.i AS i, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.s.g = bw.g),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""
