"""Blocks of documents and exchange of packed hash sets between blocks.

Suffix-array dedup and the n-gram join both start by asking which hashes occur
in more than one place. Rows of single hashes would cost a shuffle several
times the text. Instead documents are dealt into blocks of bounded size, each
block sends every bucket (a range of the hash space) one packed, sorted array
of its distinct hashes, so a hash that a block holds a thousand times, or a
group of copies, costs one entry per block; the bucket answers each block.
The next pass visits the blocks again and finds the answers beside them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, shuffle_partitions, with_row

BLOCK_BYTES = 4 << 20
#: Bits of a hash that are exchanged. Two hashes that meet in them only make a candidate more.
BITS = 48
P = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply and shift rounds); wraps."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values, from runs of powers of two."""
    out, done, run, length = None, 0, values.astype(np.uint64), 1
    while size:
        if size & 1:
            if out is None:
                out, done = run, length
            else:
                n = max(0, len(values) - done - length + 1)
                out = out[:n] * np.uint64(pow(P, length, 1 << 64)) + run[done:done + n]
                done += length
        size >>= 1
        if size:
            n = max(0, len(run) - length)
            run = run[:n] * np.uint64(pow(P, length, 1 << 64)) + run[length:length + n]
            length *= 2
    return mix(out)


def bucket_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` shuffle partitions a number that hash partitioning sends there, so that each gets one bucket."""
    found: dict[int, int] = {}
    start = 0
    while len(found) < n:
        ids = spark.range(start, start + 16 * n).select(F.col("id").cast("int").alias("key"))
        for r in ids.select("key", F.pmod(F.hash("key"), F.lit(n)).alias("part")).collect():
            found.setdefault(r.part, r.key)
        start += 16 * n
    return [found[i] for i in range(n)]


def blocked(spark: SparkSession, docs: DataFrame, columns: list, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """``docs`` with ``__llm_row``, the given columns, ``text`` as bytes (null: empty) and ``block``; the key of each bucket.

    Blocks grow with the number of buckets, so that packed arrays stay worth their row at any size.
    """
    buckets = max(2, shuffle_partitions(spark))
    size = max(block_bytes, 1024 * buckets)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(buckets, -(-total // size))
    rows = with_row(docs).select(ROW, *columns, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return rows.withColumn("block", F.pmod(F.xxhash64(ROW), F.lit(blocks)).cast("int")), bucket_keys(spark, buckets)


def by_row(block: pa.Table) -> pa.Table:
    """A block in the order of its rows, whatever order the shuffle gave it."""
    return block.combine_chunks().sort_by(ROW)


def bucket_bounds(buckets: int) -> np.ndarray:
    """First hash of each bucket but the first."""
    return np.array([(i << BITS) // buckets for i in range(1, buckets)], np.uint64)


def shorten(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - BITS)


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Sorted distinct hashes as 4-byte steps, and the high parts of the few longer steps."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    high = (steps >> np.uint64(32)).astype(np.uint32)
    at = np.flatnonzero(high).astype(np.uint32)
    return np.concatenate((np.array([len(steps), len(at)], np.uint32), steps.astype(np.uint32), at, high[at])).tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint32)
    n, k = int(raw[0]), int(raw[1])
    steps = raw[2:2 + n].astype(np.uint64)
    steps[raw[2 + n:2 + n + k]] |= raw[2 + n + k:].astype(np.uint64) << np.uint64(32)
    return np.cumsum(steps, dtype=np.uint64)


def split(sorted_hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the non-empty buckets of a sorted array."""
    cuts = np.concatenate(([0], np.searchsorted(sorted_hashes, bucket_bounds(buckets)), [len(sorted_hashes)]))
    return [(b, int(cuts[b]), int(cuts[b + 1])) for b in range(buckets) if cuts[b] < cuts[b + 1]]


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words (runs of other than ASCII white space) of a byte array."""
    inside = np.concatenate(([False], ~SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P and 1/P to the powers 0..n, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1 << 16, n + n // 8)
        _POWERS[:] = [np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, f, np.uint64), dtype=np.uint64)))
                      for f in (P, pow(P, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word, from differences of one running sum over the bytes."""
    up, down = powers(len(data) + 1)
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)))
    return mix((running[end] - running[begin]) * down[begin] + (end - begin).astype(np.uint64))
