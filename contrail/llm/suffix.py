"""Suffix-array dedup: repeats of at least ``MIN_BYTES`` bytes from a common-prefix interval tree.

1. Every ``MIN_BYTES``-byte window is known by the smallest hash of the
   ``GRAM``-byte grams in it: equal windows have equal smallest hashes, and
   neighbouring windows mostly share theirs. Hashes that occur in one document
   only cannot belong to a repeat and go no further (see ``blocks``).
2. The windows of a repeated hash travel as contexts (runs of windows with
   their bytes) to the hash's bucket. A context that a block holds many times
   travels once, with its smallest document.
3. Each bucket builds an enhanced suffix array of its windows (suffixes in
   lexicographic order with common-prefix lengths and left bytes) and scans it
   with a stack into the interval tree. The roots at ``MIN_BYTES`` are the
   groups of equal windows with all their occurrences; inner intervals whose
   occurrences differ in the byte before them are maximal repeats.
4. Blocks hear which of their windows also start in a smaller document, and
   cut or report the bytes these windows cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import blocks as B
from contrail.llm.common import ROW, carry, own_names, table

MIN_BYTES = 50
GRAM = 24
NO_ID = np.iinfo(np.int64).max
SEGMENT = 1 << 15
#: Windows of one suffix array; a bucket with more is worked through in pieces by key.
WINDOWS = 400_000
CONTEXTS = "bucket int, block int, number binary, length binary, doc binary, left binary, key binary, data binary"
SPANS = "array<struct<begin:long,end:long>>"


def window_keys(data: np.ndarray, min_bytes: int, gram: int) -> np.ndarray:
    """Smallest gram hash of each window of some bytes (none for fewer), in segments that stay in cache."""
    out = []
    for at in range(0, max(0, len(data) - min_bytes + 1), SEGMENT):
        hashes, width, length = B.rolling(data[at:at + SEGMENT + min_bytes - 1], gram), min_bytes - gram + 1, 1
        while length * 2 <= width:
            hashes, length = np.minimum(hashes[:-length], hashes[length:]), length * 2
        rest = width - length
        out.append(B.shorten(B.mix(np.minimum(hashes[:-rest], hashes[rest:]) if rest else hashes)))  # smallest ones are small: spread them out
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def gather(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of some ranges, one after the other."""
    ends = np.cumsum(length)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + length, length)]


def same(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows grouped by equal keys: the order that puts groups together, each group's first place in it, and each row's group."""
    order = np.lexsort(keys)
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for k in keys:
        fresh[1:] |= k[order][1:] != k[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return order, np.flatnonzero(fresh), group


class Block:
    """Documents of a block, their bytes one after the other with a byte between, and each run of windows that share a key."""

    def __init__(self, rows: pa.Table, min_bytes: int, gram: int):
        self.rows = B.by_row(rows)
        self.ids = np.array([NO_ID if i is None else i for i in self.rows["doc_id"].to_pylist()], np.int64)
        texts = self.rows["text"].to_pylist()
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.size = np.array([len(t) for t in texts], np.int64)
        self.base = np.cumsum(self.size + 1) - self.size - 1
        key = window_keys(self.data, min_bytes, gram)
        windows = np.maximum(self.size - min_bytes + 1, 0)
        owner = np.repeat(np.arange(len(texts)), windows)
        at = gather(np.arange(len(key)), self.base, windows)  # starts of windows inside one document
        key = key[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(fresh)
        self.doc, self.start, self.key = owner[first], at[first], key[first]
        self.windows = np.diff(np.append(first, len(at)))

    def repeated_here(self) -> np.ndarray:
        """Keys that occur in two documents of the block or more."""
        order = np.lexsort((self.doc, self.key))
        key, doc = self.key[order], self.doc[order]
        return np.unique(key[1:][(key[1:] == key[:-1]) & (doc[1:] != doc[:-1])])


class Contexts:
    """Contexts of repeated keys in a block: its occurrences, and the distinct ones among them, numbered.

    Contexts are the same if key, length and a 64-bit hash of their bytes are. ``left`` is the byte
    before, -1 at a document's begin and 256 where occurrences differ in it.
    """

    def __init__(self, block: Block, repeated: np.ndarray, min_bytes: int):
        hit = np.zeros(0, np.int64)
        if len(repeated):
            at = np.minimum(np.searchsorted(repeated, block.key), len(repeated) - 1)
            hit = np.flatnonzero(repeated[at] == block.key)
        self.doc, self.start, self.windows = block.doc[hit], block.start[hit], block.windows[hit]
        self.length = self.windows + min_bytes - 1
        key = block.key[hit]
        hashes = B.word_hashes(block.data, self.start, self.start + self.length)
        order, first, self.number = same(hashes, self.length.astype(np.uint64), key)
        left = np.where(self.start > block.base[self.doc], block.data[np.maximum(self.start - 1, 0)].astype(np.int64), -1) if len(hit) else hit
        if len(first):
            self.smallest = np.minimum.reduceat(block.ids[self.doc][order], first)
            low, high = np.minimum.reduceat(left[order], first), np.maximum.reduceat(left[order], first)
            self.left = np.where(low == high, low, 256)
        else:
            self.smallest = self.left = first
        one = order[first]
        self.key, self.begin, self.size = key[one], self.start[one], self.length[one]


def interval_tree(common: list[int], least: int) -> list[tuple[int, int, int, int]]:
    """Intervals of the tree of common prefixes, by one stack scan: ``(length, first, last, parent length)`` with length >= ``least``.

    ``common[i]`` is the common-prefix length of suffixes i and i + 1.
    """
    out, stack = [], []  # open intervals: (length, first)
    for i, now in enumerate([*common, 0]):
        first = i
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            out.append((length, first, i, max(now, stack[-1][0] if stack else 0)))
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))
    return out


class SuffixArray:
    """Enhanced suffix array of the windows of some contexts, compared by their first ``depth`` bytes (their ends count as zeros)."""

    def __init__(self, contexts: np.ndarray, lengths: np.ndarray, min_bytes: int, depth: int):
        data = np.concatenate([contexts, np.zeros(depth + 8, np.uint8)])
        ends = np.cumsum(lengths)
        begins = ends - lengths
        per = lengths - min_bytes + 1
        self.context = np.repeat(np.arange(len(lengths)), per)
        offset = np.arange(len(self.context)) - np.repeat(np.cumsum(per) - per, per)
        start = begins[self.context] + offset
        rest = ends[self.context] - start
        big = np.zeros(len(data) - 7, np.uint64)
        for i in range(8):
            big = (big << np.uint64(8)) | data[i:len(data) - 7 + i]
        heads = list(range(0, depth - 7, 8)) + ([depth - 8] if depth % 8 else [])
        keys = []
        for h in heads:
            word = big[start + h]
            if h + 8 > min_bytes:  # beyond the context's end there is nothing
                over = np.clip(h + 8 - rest, 0, 8).astype(np.uint64)
                word = np.where(over >= 8, np.uint64(0), (word >> (over * np.uint64(8) % np.uint64(64))) << (over * np.uint64(8) % np.uint64(64)))
            keys.append(word)
        self.order = np.lexsort(keys[::-1])
        common = np.full(max(0, len(self.order) - 1), depth)
        for h, word in reversed(list(zip(heads, keys))):
            word = word[self.order]
            differ = word[1:] ^ word[:-1]
            at = np.flatnonzero(differ)
            lead = sum((differ[at] < np.uint64(1 << (8 * j))).astype(np.int64) for j in range(1, 8))
            common[at] = h + lead
        short = np.minimum(rest[self.order][1:], rest[self.order][:-1])
        self.common = np.minimum(common, short)
        self.context, self.offset, self.start = self.context[self.order], offset[self.order], start[self.order]
        self.data, self.begins = data, begins

    def left(self, context_left: np.ndarray) -> np.ndarray:
        """Byte before each suffix: the context's for its first window."""
        return np.where(self.offset == 0, context_left[self.context], self.data[np.maximum(self.start - 1, 0)].astype(np.int64))

    def roots(self, least: int) -> np.ndarray:
        """Number of the root interval (or lone suffix) of each suffix: the tree cut at ``least``."""
        return np.concatenate(([0], np.cumsum(self.common < least))) if len(self.order) else np.zeros(0, np.int64)


def read_contexts(rows: pa.Table, min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts of a bucket in pieces of about ``WINDOWS`` windows, equal keys together.

    Block, number, length, smallest id, left byte and key as arrays, and the bytes one after the other.
    """
    rows = rows.sort_by("block")
    get = {c: [np.frombuffer(v.as_buffer(), t) for v in rows[c]] for c, t in
           (("number", np.int32), ("length", np.int32), ("doc", np.int64), ("left", np.int16), ("key", np.uint64))}
    block = np.repeat(np.array(rows["block"].to_pylist(), np.int64), [len(n) for n in get["number"]])
    number, length, doc, left, key = (np.concatenate(get[c]) for c in ("number", "length", "doc", "left", "key"))
    data = np.concatenate([np.frombuffer(pa.decompress(v.as_buffer(), int(n.sum()), "zstd"), np.uint8) for v, n in zip(rows["data"], get["length"])])
    length, number, left = length.astype(np.int64), number.astype(np.int64), left.astype(np.int64)
    begin = np.cumsum(length) - length
    pieces = -(-int((length - min_bytes + 1).sum()) // WINDOWS)
    part = B.mix(key) % np.uint64(pieces)
    for i in range(pieces):
        at = np.flatnonzero(part == i)
        if len(at):
            yield block[at], number[at], length[at], doc[at], left[at], key[at], gather(data, begin[at], length[at])


def exchanged(spark: SparkSession, docs: DataFrame, columns: list, min_bytes: int, gram: int, block_bytes: int):
    """Blocks, and per block the keys that other blocks hold too; then contexts by bucket. All lazy."""
    rows, bucket_keys = B.blocked(spark, docs, columns, block_bytes)
    buckets = len(bucket_keys)

    def send(key: tuple, block: pa.Table) -> pa.Table:
        keys = np.unique(Block(block, min_bytes, gram).key)
        parts = B.split(keys, buckets)
        return pa.table({"bucket": pa.array([bucket_keys[p[0]] for p in parts], pa.int32()), "block": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                         "keys": pa.array([B.pack(keys[a:b]) for _, a, b in parts], pa.binary())})

    def answer(key: tuple, got: pa.Table) -> pa.Table:
        held = [B.unpack(v.as_py()) for v in got["keys"]]
        every = np.sort(np.concatenate(held))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        out = [h[twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h] for h in held] if len(twice) else [h[:0] for h in held]
        keep = [i for i, h in enumerate(out) if len(h)]
        return pa.table({"block": pa.array([got["block"][i].as_py() for i in keep], pa.int32()), "kind": pa.array([0] * len(keep), pa.int32()),
                         "payload": pa.array([B.pack(out[i]) for i in keep], pa.binary())})

    sent = rows.groupBy("block").applyInArrow(send, "bucket int, block int, keys binary").repartition(buckets, "bucket")
    mail = sent.groupBy("bucket").applyInArrow(answer, "block int, kind int, payload binary")

    def cut(key: tuple, block: pa.Table, letters: pa.Table) -> pa.Table:
        own, found = contexts_of(block, letters, min_bytes, gram)
        to = np.searchsorted(B.bucket_bounds(buckets), found.key, "right")
        order = np.argsort(to, kind="stable")
        full, first = np.unique(to[order], return_index=True)
        parts = np.split(order, first[1:]) if len(full) else []
        pick = lambda values, kind: pa.array([values[p].astype(kind).tobytes() for p in parts], pa.binary())
        return pa.table({
            "bucket": pa.array([bucket_keys[b] for b in full], pa.int32()), "block": pa.array([key[0].as_py()] * len(full), pa.int32()),
            "number": pick(np.arange(len(found.key)), np.int32), "length": pick(found.size, np.int32),
            "doc": pick(found.smallest, np.int64), "left": pick(found.left, np.int16), "key": pick(found.key, np.uint64),
            "data": pa.array([pa.compress(gather(own.data, found.begin[p], found.size[p]).tobytes(), "zstd", asbytes=True) for p in parts], pa.binary())})

    contexts = rows.groupBy("block").cogroup(mail.groupBy("block")).applyInArrow(cut, CONTEXTS).repartition(buckets, "bucket")
    return rows, mail, contexts


def contexts_of(block: pa.Table, letters: pa.Table, min_bytes: int, gram: int) -> tuple[Block, Contexts]:
    """The block and its contexts, given the letters with the keys that other blocks hold."""
    own = Block(block, min_bytes, gram)
    elsewhere = [B.unpack(p.as_buffer()) for p, kind in zip(letters["payload"], letters["kind"].to_pylist()) if kind == 0]
    return own, Contexts(own, np.unique(np.concatenate([own.repeated_here(), *elsewhere])), min_bytes)


def duplicate_spans(spark: SparkSession, docs: DataFrame, min_bytes: int = MIN_BYTES, gram: int = GRAM,
                    block_bytes: int = B.BLOCK_BYTES, others: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Bytes of each row of ``docs(doc_id, text)`` that lie in a window which also starts in a document of smaller id.

    Columns ``__llm_row, doc_id, n_bytes, spans`` (byte ranges, disjoint, in order) ``, kept`` (the other
    bytes); with ``others`` also every other column of ``docs`` under safe names, whose meaning the
    returned mapping gives, ``__null`` (text was null), and ``kept`` without bytes of characters cut in two. Windows are judged on the input. Null text is empty; a null id is larger than
    any; rows of one id never cut each other; texts under ``min_bytes`` bytes keep all.
    """
    more, back = carry(docs, ("doc_id", "text")) if others else ([], {})
    if others:
        more.append(docs["text"].isNull().alias("__null"))
    own_id = F.col("doc_id").cast("long").alias("doc_id")
    rows, mail, contexts = exchanged(spark, docs, [own_id, *more], min_bytes, gram, block_bytes)

    def judge(key: tuple, got: pa.Table) -> pa.Table:
        pieces = []
        for block, number, length, doc, _, key, data in read_contexts(got, min_bytes):
            ends = np.cumsum(length)
            order, first, group = same(B.word_hashes(data, ends - length, ends), length.astype(np.uint64), key)
            one = order[first]  # of a context that many blocks hold, one goes into the array
            suffixes = SuffixArray(gather(data, (ends - length)[one], length[one]), length[one], min_bytes, min_bytes)
            root = suffixes.roots(min_bytes)
            owner = np.minimum.reduceat(doc[order], first)[suffixes.context]
            least = np.minimum.reduceat(owner, np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1]))))[root]
            # the windows of each distinct context, in order, then for each block that has it
            place = np.lexsort((suffixes.offset, suffixes.context))
            least, windows = least[place], length[one] - min_bytes + 1
            begin = np.cumsum(windows) - windows
            own = length - min_bytes + 1
            heard = gather(least, begin[group], own)
            told = np.flatnonzero(heard < np.repeat(doc, own))
            context = np.repeat(np.arange(len(own)), own)[told]
            offset = told - (np.cumsum(own) - own)[context]
            pieces.append(np.stack([block[context], number[context], offset], 1).astype(np.int32))
        out = np.concatenate(pieces)
        out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
        to, first = np.unique(out[:, 0], return_index=True)
        parts = np.split(out[:, 1:], first[1:]) if len(to) else []
        return pa.table({"block": pa.array(to.tolist(), pa.int32()), "kind": pa.array([1] * len(to), pa.int32()),
                         "payload": pa.array([runs(p).tobytes() for p in parts], pa.binary())})

    told = contexts.groupBy("bucket").applyInArrow(judge, "block int, kind int, payload binary")
    letters = mail.unionByName(told)
    fields = rows.drop("text", "block").schema
    names = fields.fieldNames()
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"n_bytes long, spans {SPANS}, kept binary"])

    def finish(key: tuple, block: pa.Table, letters: pa.Table) -> pa.Table:
        own, found = contexts_of(block, letters, min_bytes, gram)
        edge = np.zeros(len(own.data) + 1, np.int64)  # +1 where a removed window's bytes begin, -1 where they end
        inner = own.ids[found.doc] > found.smallest[found.number] if len(found.doc) else np.zeros(0, bool)
        begins, ends = [found.start[inner]], [(found.start + found.length)[inner]]  # another document here has the whole context
        heard = [np.frombuffer(p.as_buffer(), np.int32).reshape(-1, 3) for p, kind in zip(letters["payload"], letters["kind"].to_pylist()) if kind == 1]
        if heard:
            told = np.concatenate(heard).astype(np.int64)
            told = told[np.argsort(told[:, 0], kind="stable")]
            rest = np.flatnonzero(~inner)
            low, high = (np.searchsorted(told[:, 0], found.number[rest], side) for side in ("left", "right"))
            which = gather(np.arange(len(told)), low, high - low)
            start = np.repeat(found.start[rest], high - low)
            begins.append(start + told[which, 1])
            ends.append(start + told[which, 2] + min_bytes - 1)
        np.add.at(edge, np.concatenate(begins), 1)
        np.add.at(edge, np.concatenate(ends), -1)
        gone = np.concatenate(([False], np.cumsum(edge) > 0))
        turns = np.flatnonzero(gone[1:] != gone[:-1])  # no span reaches the byte between documents
        of = np.searchsorted(own.base, turns[::2], "right") - 1
        spans: list[list[dict]] = [[] for _ in own.size]
        for doc, a, b in zip(of.tolist(), turns[::2].tolist(), turns[1::2].tolist()):
            spans[doc].append({"begin": a - int(own.base[doc]), "end": b - int(own.base[doc])})
        kept = []
        for cut, a, n in zip(spans, own.base.tolist(), own.size.tolist()):
            text = own.data[a:a + n]
            if cut:
                text = text[~gone[1 + a:1 + a + n]]
            text = text.tobytes()
            kept.append(text.decode("utf-8", "ignore").encode() if others and cut else text)
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        got = own.rows.select(names)
        for name, values in (("n_bytes", pa.array(own.size, pa.int64())), ("spans", pa.array(spans, kind)),
                             ("kept", pa.array(kept, pa.binary()))):
            got = got.append_column(name, values)
        return got

    return rows.groupBy("block").cogroup(letters.groupBy("block")).applyInArrow(finish, schema), back


def runs(pairs: np.ndarray) -> np.ndarray:
    """(context, offset) in order as (context, first offset, end offset) of consecutive offsets."""
    fresh = np.concatenate(([True], (pairs[1:, 0] != pairs[:-1, 0]) | (pairs[1:, 1] != pairs[:-1, 1] + 1)))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(pairs)) - 1
    return np.stack([pairs[first, 0], pairs[first, 1], pairs[last, 1] + 1], 1).astype(np.int32)


def repeat_groups(spark: SparkSession, docs: DataFrame, min_bytes: int = MIN_BYTES, gram: int = GRAM, horizon: int | None = None,
                  block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Maximal repeat groups of ``docs(doc_id, text)`` between documents, with all occurrences.

    ``length`` bytes, ``sample`` (the repeated bytes), ``occurrences`` (block, context number, offset in the
    context, smallest doc_id there): an interval of at least ``min_bytes`` whose occurrences differ in the byte before them
    (left-diverse) and in the byte after. Repeats are followed up to ``horizon`` bytes (default: a context,
    ``2 * min_bytes - gram``); longer ones appear as successive groups.
    """
    depth = horizon or 2 * min_bytes - gram
    _, _, contexts = exchanged(spark, docs, [F.col("doc_id").cast("long").alias("doc_id")], min_bytes, gram, block_bytes)
    kind = pa.list_(pa.struct([("block", pa.int32()), ("context", pa.int32()), ("offset", pa.int32()), ("doc_id", pa.int64())]))

    def groups(key: tuple, got: pa.Table) -> pa.Table:
        sizes, samples, all_ = [], [], []
        for block, number, length, doc, left, _, data in read_contexts(got, min_bytes):
            suffixes = SuffixArray(data, length, min_bytes, depth)
            before = suffixes.left(left)
            for size, first, last, _ in interval_tree(suffixes.common.tolist(), min_bytes):
                span = slice(first, last + 1)
                if len(np.unique(before[span])) == 1 and 0 <= before[first] < 256:
                    continue  # every occurrence goes on to the left: a longer repeat has them
                at = suffixes.start[first]
                sizes.append(size)
                samples.append(suffixes.data[at:at + size].tobytes())
                all_.append([{"block": int(block[x]), "context": int(number[x]), "offset": int(o), "doc_id": int(doc[x])}
                             for x, o in zip(suffixes.context[span], suffixes.offset[span])])
        return pa.table({"length": pa.array(sizes, pa.int64()), "sample": pa.array(samples, pa.binary()), "occurrences": pa.array(all_, kind)})

    return contexts.groupBy("bucket").applyInArrow(
        groups, "length long, sample binary, occurrences array<struct<block:int,context:int,offset:int,doc_id:long>>")


@own_names
def deduplicated_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` without repeated bytes; a document of which nothing is left goes, others keep their columns (``n_chars`` anew where cut).

    A cut inside a character drops its remaining bytes.
    """
    found, back = duplicate_spans(spark, docs, others=True, **options)
    names = {name: safe for safe, name in back.items()}
    text = F.col("kept").cast("string")
    cut = F.size("spans") > 0
    out = found.where(~cut | (F.octet_length("kept") > 0))
    return out.select(*[
        F.col("doc_id").cast(docs.schema[c].dataType).alias(c) if c == "doc_id"
        else F.when(F.col("__null"), None).otherwise(text).alias(c) if c == "text"
        else F.when(cut, F.length(text).cast(docs.schema[c].dataType)).otherwise(F.col(names[c])).alias(c) if c == "n_chars"
        else F.col(names[c]).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = duplicate_spans(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.begin)").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
