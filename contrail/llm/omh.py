"""Order MinHash: fingerprints sensitive to edit distance.

For each of ``HASHES`` hash functions, the ``TUPLE`` k-mers (numbered by
occurrence, so repeats differ) with the smallest hashes are kept in text order
and the tuple of their hashes is hashed to one entry. The share of equal
entries estimates likeness in content and order, hence in edit distance.

"The next document" by id is found without a global window: bounds on ids (a
quantile sketch) cut the documents into buckets, the first document of each
bucket is also sent to the bucket before it as a guest, and each bucket is read
in order in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import shuffle_partitions, table

KMER = 12
HASHES = 64
TUPLE = 2
BLOCK = 8192
SEED = 20240229


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply and shift rounds); wraps."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def kmers(text: str, k: int = KMER) -> np.ndarray:
    """Hashes of the occurrence-numbered k-mers in text order (one for a shorter text, none for an empty one)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(codes):
        return codes
    size, step = min(k, len(codes)), 0x9E3779B97F4A7C15
    out, done, run, length = None, 0, codes, 1
    while size:  # k-grams of any k from those of powers of two
        if size & 1:
            if out is None:
                out, done = run, length
            else:
                n = len(codes) - done - length + 1
                out = out[:n] * np.uint64(pow(step, length, 1 << 64)) + run[done:done + n]
                done += length
        size >>= 1
        if size:
            n = len(run) - length
            run = run[:n] * np.uint64(pow(step, length, 1 << 64)) + run[length:length + n]
            length *= 2
    out = _mix(out + np.uint64(len(codes) if len(codes) < k else 0))
    ordered = np.sort(out)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(repeated):
        at = np.flatnonzero(np.isin(out, repeated))
        by = at[np.argsort(out[at], kind="stable")]
        values = out[by]
        starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        number = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
        out[by] = _mix(values + number.astype(np.uint64) * np.uint64(step))
    return out


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, HASHES, np.uint32)[:, None], (rng.integers(0, 1 << 31, HASHES, np.uint32) * 2 + 1)[:, None]


def signature(text: str) -> np.ndarray:
    """``HASHES`` 16-bit entries; all zero for an empty text."""
    grams = kmers(text)
    if not len(grams):
        return np.zeros(HASHES, np.uint16)
    shift, factor = _functions()
    low = (grams >> np.uint64(32)).astype(np.uint32)
    keep_hash = np.full((HASHES, TUPLE), np.iinfo(np.uint32).max, np.uint32)
    keep_at = np.full((HASHES, TUPLE), np.iinfo(np.int64).max, np.int64)
    line = np.arange(HASHES)
    for start in range(0, len(low), BLOCK):  # a block stays in cache; the smallest so far are merged in
        values = (low[None, start:start + BLOCK] ^ shift) * factor
        values ^= values >> np.uint32(15)
        best_hash, best_at = [keep_hash], [keep_at]
        for _ in range(min(TUPLE, values.shape[1])):
            at = values.argmin(axis=1)
            best_hash.append(values[line, at][:, None])
            best_at.append((at + start)[:, None])
            values[line, at] = np.iinfo(np.uint32).max
        hashes, places = np.hstack(best_hash), np.hstack(best_at)
        order = np.lexsort((places, hashes), axis=1)[:, :TUPLE]
        keep_hash, keep_at = np.take_along_axis(hashes, order, 1), np.take_along_axis(places, order, 1)
    keep_at.sort(axis=1)  # back to text order
    entry = np.zeros(HASHES, np.uint64)
    for j in range(TUPLE):
        there = keep_at[:, j] < len(grams)
        entry = _mix(entry + np.where(there, grams[np.minimum(keep_at[:, j], len(grams) - 1)], np.uint64(1)))
    return (entry >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many (or all) first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def ordered_buckets(spark: SparkSession, docs: DataFrame, buckets: int) -> DataFrame:
    """``docs(doc_id, text)`` with ``bucket`` (descending id, null last) and ``guest``: the head of the next bucket.

    Equal ids are ordered by text; they always share a bucket.
    """
    ids = docs.select("doc_id")
    share = [i / buckets for i in range(1, buckets)]
    bounds = ids.agg(F.percentile_approx("doc_id", share, 20 * buckets).alias("b")).first().b if share else None
    bounds = sorted({b for b in bounds or []}, reverse=True)  # one number per bucket
    steps = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
    bucket = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(F.size(F.filter(steps, lambda b: F.col("doc_id") < b)))
    own = docs.select("doc_id", "text", bucket.cast("int").alias("bucket"))
    heads = own.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()  # one row per bucket
    order = sorted(r.bucket for r in heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first bucket's head follows the last bucket
    rows = [(r.bucket, r.head, before[r.bucket]) for r in heads]
    frame = spark.createDataFrame(rows, "of int, head bigint, before int")
    guests = own.join(F.broadcast(frame), (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head")))
    return own.withColumn("guest", F.lit(False)).unionByName(
        guests.select("doc_id", "text", F.col("before").alias("bucket"), F.lit(True).alias("guest")))


def fingerprints(spark: SparkSession, docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text of ``docs(doc_id, text)`` and of its edited text.

    Columns ``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next``.
    Null text is empty; an empty text has the all-zero fingerprint and is wholly like another empty
    one. A single document is followed by itself; rows of equal id follow in order of text.
    """
    n = shuffle_partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = ordered_buckets(spark, docs, buckets or 4 * n)
    sorted_rows = placed.repartition(n, "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").desc_nulls_last(), "text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in range(7)]
        size = 0

        def out() -> pa.RecordBatch:
            nonlocal size
            made = pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                 pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string()), pa.array(columns[5], pa.float64()),
                 pa.array(columns[6], pa.float64())],
                ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            for c in columns:
                c.clear()
            size = 0
            return made

        last = None  # (bucket, doc_id, text, signature) whose follower is not known yet

        def close(following: str, next_signature: np.ndarray) -> None:
            nonlocal size
            _, doc_id, text, own = last
            changed = edited(text, following)
            other = own if changed == text else signature(changed)
            for c, v in zip(columns, (doc_id, len(text), changed, own.astype(">u2").tobytes().hex(), other.astype(">u2").tobytes().hex(),
                                      likeness(own, other), likeness(own, next_signature))):
                c.append(v)
            size += len(changed)

        for batch in batches:
            for doc_id, text, bucket, guest in zip(*(batch.column(i) for i in range(4))):
                doc_id, text, bucket, guest = doc_id.as_py(), text.as_py(), bucket.as_py(), guest.as_py()
                if guest and (last is None or last[0] != bucket):
                    continue  # only the first guest of a bucket follows its last document
                own = signature(text)
                if last is not None:
                    close(text, own)
                    if size > 8_000_000:
                        yield out()
                last = None if guest else (bucket, doc_id, text, own)
        yield out()

    return sorted_rows.select("doc_id", "text", "bucket", "guest").mapInArrow(
        sign, "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                        "fingerprint", "edited_fingerprint", "near_edited", "near_next")
