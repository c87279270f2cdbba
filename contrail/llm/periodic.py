"""Periodic run detection: words that repeat with a short period, by seed and extend on diagonals.

A run is a stretch of consecutive words with smallest period q that no neighbour extends, at least
``max(6, 4 q)`` words long. Along the diagonal of lag q (word i against word i + q) it is a stretch
of ``max(6 - q, 3 q)`` matches at least: the minimum guaranteed overlap. Lags are taken in bands,
1-5, 6-18, 19-57, ..., and each band is seeded by the k-grams of the overlap that its smallest lag
guarantees (k = 5, 18, 57, ...), which is no less than its largest lag. Two facts follow for the
rows of one k-gram's occurrences in a document:

- inside a run of lag q <= k the next occurrence of a k-gram is exactly q words on (its first q
  words are a primitive word, which differs from its rotations), so the pairs of neighbouring
  occurrences hold a seed of every run and no k-gram needs all its pairs;
- a pair at distance d <= k is a repetition of smallest period d, so few diagonals are walked.

Seeds are taken in order of lag and position. A table of how far each lag is covered passes over
seeds inside a stretch already walked; others are extended both ways word by word. A k-gram that
occurs twice has parts that do, so each band looks only where the last one found repeats: text
without repeats costs one sort of its 5-grams.

A document is one row of one task; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, table, with_row

#: Words are runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD.encode())
#: A run has LEAST words and TIMES periods at least.
LEAST, TIMES = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def bands(n: int) -> Iterator[tuple[int, int]]:
    """(largest lag, length of the seeding k-gram) of each band of lags that ``n`` words can have."""
    top = LEAST - 1
    yield top, top
    while TIMES * (top + 1) <= n:
        top = (TIMES - 1) * (top + 1)
        yield top, top


def longer(n: int, at: np.ndarray, name: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated grams ``step`` words longer, from the positions (in order) and names of repeated grams of at least ``step`` words.

    Grams are named by pairs of names, so equal names mean equal words. Returned in order of name, then position.
    """
    known = np.full(n + 1, -1, np.int64)
    known[at] = name
    tail = known[np.minimum(at + step, n)]
    both = tail >= 0
    at, key = at[both], name[both] * np.int64(n + 1) + tail[both]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))
    first = np.flatnonzero(new)
    again = np.repeat(np.diff(first, append=len(key)) > 1, np.diff(first, append=len(key)))
    return at[again], (np.cumsum(new) - 1)[again]


def matches(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays, compared in doubling pieces."""
    n, done, size = min(len(a), len(b)), 0, 64
    while done < n:
        unlike = np.flatnonzero(a[done:min(n, done + size)] != b[done:min(n, done + size)])
        if len(unlike):
            return done + int(unlike[0])
        done, size = done + size, size * 2
    return n


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of an array of word numbers, by start, then period."""
    n, out = len(ids), []
    covered: dict[int, int] = {}  # lag -> end of the diagonal walked last
    at, name = np.arange(n, dtype=np.int64), ids.astype(np.int64)
    size, below = 1, 0
    for lag, k in bands(n):
        while size < k:
            step = min(size, k - size)
            order = np.argsort(at, kind="stable")
            at, name = longer(n, at[order], name[order], step)
            size += step
        far = np.diff(at)
        pair = np.flatnonzero((name[1:] == name[:-1]) & (far > below) & (far <= lag))
        begin, far = at[pair], far[pair]
        order = np.lexsort((begin, far))
        begin, far = begin[order], far[order]
        head = np.ones(len(begin), bool)  # a seed beside another on its diagonal is of the same stretch
        head[1:] = (far[1:] != far[:-1]) | (begin[1:] != begin[:-1] + 1)
        for i, q in zip(begin[head].tolist(), far[head].tolist()):
            if i < covered.get(q, 0):
                continue
            end = i + matches(ids[i:], ids[i + q:])
            first = i - matches(ids[:i][::-1], ids[:i + q][::-1])
            covered[q] = end
            if end - first + q >= max(LEAST, TIMES * q):
                out.append((first, end - first + q, q))
        below = lag
        if not len(at):
            break
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number among the document's distinct words."""
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(place.__getitem__, words), np.int64, len(words))


def kept_words(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: a run keeps its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``__llm_row, doc_id, runs, collapsed`` of every row of ``docs(doc_id, text)``, whole texts.

    ``runs``: every (start, length, period) in words, by start, then period. ``collapsed``: the text without the words that a run
    repeats after its first period, joined by one space. Null and wordless texts have no run and an empty ``collapsed``; repeated
    rows give a row each; an empty table gives none.
    """
    rows = with_row(docs.select("doc_id", "text")).select(ROW, "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for text in batch.column(2):
                words = WORDS.findall(text.as_py())
                here = runs(numbered(words)) if len(words) >= LEAST else []
                found.append([{"start": a, "length": n, "period": q} for a, n, q in here])
                kept.append(b" ".join(kept_words(words, here)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(RUN)), pa.array(kept, pa.string())],
                                             [ROW, "doc_id", "runs", "collapsed"])

    ident = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"{ROW} long, doc_id {ident}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with periodic words written into every tenth document by the checksum of its id.

    With h = crc32 of the decimal id and g = floor(h / 10): if h % 10 = 0, each word from a = g % n on becomes the original word
    a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). Rows with a null id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    # the columns each build on the last; a text of another document is not split
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Counts, strongest run and digests of each row of ``periodic_runs``."""
    def stronger(best: Column, run: Column) -> Column:
        # exact: length / period by cross products; runs come by start, then period, so a tie keeps the earlier one
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", none, stronger)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    b = F.col("best")
    return rows.select("doc_id", "n_runs", b["start"].alias("start"), b["length"].alias("length"), b["period"].alias("period"),
                       F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                       F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``, with periodic words written into a tenth of them."""
    return digests(periodic_runs(spark, planted(table(spark, sf_dir, "documents"))))
