"""Hashed maximum-entropy language model with a class-factored softmax.

Counts of all training tokens come first. The ``WORDS`` most frequent tokens are items of their own; every
other token, seen or not, belongs to one of ``BINS`` items by its last bytes, and inside its bin a token has
the add-one share ``(c + 1) / (tokens + kinds + 1)``, the unit left over being all unseen tokens of the bin.
Items are dealt into ``CLASSES`` classes of ``MEMBERS`` (words of like endings share a class), and

    P(token | history) = P(class | history) P(item | class, history) P(token | item).

Both softmaxes start from the logarithms of the counts and add the weights of hashed features of the history:
the last item (bigram), the item two back (skip), and the last two words (trigram) for the class; the last
item and the one two back, each with the class, for the item.

Training is by distributed gradient updates: in each of ``ROUNDS`` rounds every task walks its share of the
documents once, from the round's broadcast weights, in batches (AdaGrad), and hands over its change and count
of each weight row that it touched; the changes of a row are averaged by these counts. The weights are
``2 * ROWS`` rows whatever the corpus is, so what is broadcast and collected is bounded by parameters, while
the counts, of every token, are joined and never held whole: a bounded table of frequent tokens travels with
the scan, all others are joined on the token. Texts are walked as one stream of tokens in pieces of a bounded
size, cut between words, so a text of any length is scored whole.

Tokens are told apart by a 64-bit hash of their bytes (of 10**8 kinds, some pair is alike with a chance of 1 in 4,000).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.blocks import P, SPACE, mix, words
from contrail.llm.common import ROW, table, with_row
from contrail.llm.langid import hot_cut
from contrail.session import materialize

CLASSES, MEMBERS = 16, 32
BINS = 128
WORDS = CLASSES * MEMBERS - BINS
#: Hashed weight rows of each of the two softmaxes.
ROWS = 1 << 13
ROUNDS = 2
RATE = 0.3
#: Weights stay within this, so that sums of them need no scaling before exp().
LIMIT = 8.0
#: Tokens of one gradient update, and of one pass through the softmaxes.
BATCH, PASS = 1 << 16, 1 << 10
#: Bytes of text that a task turns into arrays at once.
PIECE = 1 << 17
#: Bound of the broadcast table of frequent tokens.
HOT = 1 << 18
#: Token counts that a task holds before it puts them together, and hands over what stays distinct.
FLUSH = 1 << 20
#: Weight rows that travel as one row, and changes that one task adds up.
TOGETHER, FAN_IN = 64, 256
END_ITEM = 0


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text mod 7 is 2; false for a null id (which is not learned from either)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def lowered(text: bytes | None) -> bytes:
    return (text or b"").lower()  # of bytes: A-Z alone


# ---------------------------------------------------------------- tokens as arrays
def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; zeros follow the last."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ascontiguousarray(np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)))


#: The lowest n bytes, n = 0 to 8.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer words are digested one by one.
LONG = 256


def numbers(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, and its bin by its last four bytes (or all of a shorter one)."""
    load, length = eights(data), end - begin
    first = load[begin] & MASKS[np.minimum(length, 8)]
    hashed = mix(first * np.uint64(P) + length.astype(np.uint64))
    on = np.flatnonzero((length > 8) & (length <= LONG))
    for at in range(8, LONG, 8):
        on = on[length[on] > at]
        if not len(on):
            break
        hashed[on] = mix(hashed[on] * np.uint64(P) + (load[begin[on] + at] & MASKS[np.minimum(length[on] - at, 8)]))
    for i in np.flatnonzero(length > LONG).tolist():
        hashed[i] = int.from_bytes(blake2b(data[begin[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    tail = np.where(length > 4, load[np.maximum(end - 4, 0)] & MASKS[4], first & MASKS[4])
    return hashed, (mix(tail + (np.minimum(length, 4).astype(np.uint64) << np.uint64(40))) % np.uint64(BINS)).astype(np.intp)


def tails(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The last eight bytes of each word, the last one highest: words of like endings are near each other."""
    load, short = eights(data), np.maximum(8 - (end - begin), 0).astype(np.uint64)
    return load[np.maximum(end - 8, begin)] << (short * np.uint64(8))


def numbers_of(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, tokens), np.int64, len(tokens))
    end = np.cumsum(length + 1) - 1
    return numbers(np.frombuffer(b" ".join(tokens), np.uint8), end - length, end)


class Frequent:
    """Values of tokens by hash, in a table of two slots to a token; the few that find both taken are left out."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.mask = np.uint64((1 << max(4, (2 * len(hashes)).bit_length())) - 1)
        self.keys, self.values = np.zeros(int(self.mask) + 1, np.uint64), np.zeros(int(self.mask) + 1)
        left = np.arange(len(hashes))
        for which in range(2):
            slots = self.slots(hashes[left])[which]
            free = np.flatnonzero(self.keys[slots] == 0)
            at, first = np.unique(slots[free], return_index=True)
            placed = left[free[first]]
            self.keys[at], self.values[at] = hashes[placed], values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)

    def slots(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes & self.mask).astype(np.intp), (hashes >> np.uint64(32) & self.mask).astype(np.intp)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the table, and their values (0: not there)."""
        one, two = self.slots(hashes)
        here = self.keys[one] == hashes
        at = np.where(here, one, two)
        here |= self.keys[two] == hashes
        return here, np.where(here, self.values[at], 0.0)


class Items(NamedTuple):
    """The items: sorted hashes of the words among them, their numbers, and the count of every item (0: unused)."""
    hashes: np.ndarray
    numbers: np.ndarray
    mass: np.ndarray


class Stream(NamedTuple):
    """A piece of the stream of tokens: hash and item of each, its document, and the words themselves (``place``: index of each)."""
    hash: np.ndarray
    item: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: bytes


#: The end of a text, as a token.
END_HASH = mix(np.array([0x5EED], np.uint64))
END = int(END_HASH.view(np.int64)[0])


def pieces(texts: list[bytes], size: int) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Lists of (document, part of its text, whether the text ends there) of about ``size`` bytes, cut between words."""
    held, room = [], size
    for doc, text in enumerate(texts):
        at = 0
        while True:
            to = min(len(text), at + room)
            while to < len(text) and not SPACE[text[to]]:
                to += 1
            held.append((doc, text[at:to], to == len(text)))
            room -= to - at + 1
            at = to
            if room <= 0:
                yield held
                held, room = [], size
            if at == len(text):
                break
    if held:
        yield held


def stream(parts: list[tuple[int, bytes, bool]], items: Items) -> Stream:
    """Tokens of one piece, the ends in their places."""
    joined = b"\n".join(p for _, p, _ in parts)
    data = np.frombuffer(joined, np.uint8)
    begin, end = words(data)
    first = np.cumsum([0] + [len(p) + 1 for _, p, _ in parts[:-1]])
    upto = np.searchsorted(begin, np.append(first[1:], len(data) + 1))
    doc, last = np.array([d for d, _, _ in parts]), np.array([x for _, _, x in parts])
    ahead = np.cumsum(last) - last  # ends before each part
    n = np.diff(upto, prepend=0)
    place = np.arange(len(begin)) + np.repeat(ahead, n)
    ends = (upto + ahead)[last]
    hashed, item = np.empty(len(begin) + len(ends), np.uint64), np.empty(len(begin) + len(ends), np.int64)
    of = np.empty(len(hashed), np.int64)
    own, number = numbers(data, begin, end)
    number += WORDS
    if len(items.hashes):
        at = np.minimum(np.searchsorted(items.hashes, own), len(items.hashes) - 1)
        number = np.where(items.hashes[at] == own, items.numbers[at], number)
    hashed[place], item[place], of[place] = own, number, np.repeat(doc, n)
    hashed[ends], item[ends], of[ends] = END_HASH, END_ITEM, doc[last]
    return Stream(hashed, item, of, place, begin, end, joined)


# ---------------------------------------------------------------- counts
class Counted(NamedTuple):
    """Distinct tokens: hash, bin, last bytes (``tail``, by which words sort from their ends) and count of each."""
    token: np.ndarray
    bin: np.ndarray
    tail: np.ndarray
    n: np.ndarray


def squeezed(held: list[Counted]) -> Counted:
    """One row per token."""
    token, bins, tail, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(token, kind="stable")
    token = token[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(token)), bool), token[1:] != token[:-1])))
    at = order[first]
    return Counted(token[first], bins[at], tail[at], np.add.reduceat(n[order], first) if len(first) else n)


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, bin, tail, n) over the column ``text`` (binary), ends included (token ``END``); a token is a 64-bit hash."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counted] = []
        rows = 0

        def out(c: Counted) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c.token.view(np.int64)), pa.array(c.bin.astype(np.int32)), pa.array(c.tail.view(np.int64)), pa.array(c.n)],
                                              ["token", "bin", "tail", "n"])

        for batch in batches:
            ends = np.array([batch.num_rows], np.int64)
            held.append(Counted(END_HASH, np.full(1, -1, np.int64), np.zeros(1, np.uint64), ends))
            for part in pieces([lowered(t.as_py()) for t in batch.column(0)], PIECE):
                data = np.frombuffer(b"\n".join(p for _, p, _ in part), np.uint8)
                begin, end = words(data)
                token, bins = numbers(data, begin, end)
                held.append(squeezed([Counted(token, bins, tails(data, begin, end), np.ones(len(token), np.int64))]))
                rows += len(held[-1].n)
                if rows > FLUSH:
                    held = [squeezed(held)]
                    rows = len(held[0].n)
                    if rows > FLUSH // 2:  # mostly distinct tokens
                        yield out(held[0])
                        held, rows = [], 0
        if held:
            yield out(squeezed(held))

    found = texts.select("text").mapInArrow(count, "token long, bin int, tail long, n long")
    return found.groupBy("token").agg(F.max("bin").alias("bin"), F.max("tail").alias("tail"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- features and the two softmaxes
def row_of(*parts) -> np.ndarray:
    """Weight row of a feature: hash of its kind and values."""
    h = np.zeros(1, np.uint64)
    for p in parts:
        h = mix(h * np.uint64(P) + np.asarray(p).astype(np.uint64) + np.uint64(1))
    return (h % np.uint64(ROWS)).astype(np.intp)


class Lookup(NamedTuple):
    """Rows of the features of one item, by kind: for the class softmax, and for the member softmax of each class."""
    outer: list[np.ndarray]
    inner: list[np.ndarray]


def lookup() -> Lookup:
    every, classes = np.arange(CLASSES * MEMBERS), np.arange(CLASSES)[:, None]
    return Lookup([row_of(k, every) for k in (1, 2)], [row_of(k, classes, every[None, :]) for k in (5, 6)])


class Batch(NamedTuple):
    """Target classes and members of tokens, and the weight rows of their features (one line per feature)."""
    cls: np.ndarray
    member: np.ndarray
    outer: np.ndarray
    inner: np.ndarray

    def part(self, s: slice) -> Batch:
        return Batch(self.cls[s], self.member[s], self.outer[:, s], self.inner[:, s])


class History:
    """Turns pieces of the stream into features; remembers the last tokens between pieces."""

    def __init__(self):
        self.look = lookup()
        self.item, self.hash = np.full(2, END_ITEM), np.repeat(END_HASH, 2)

    def features(self, item: np.ndarray, hashed: np.ndarray) -> Batch:
        items, hashes = np.concatenate((self.item, item)), np.concatenate((self.hash, hashed))
        n = len(item)
        self.item, self.hash = items[n:], hashes[n:]
        one = items[1:n + 1]
        # nothing of the text before: what lies beyond an end is an end
        two, far = np.where(one == END_ITEM, END_ITEM, items[:n]), np.where(one == END_ITEM, END_HASH, hashes[:n])
        pair = mix(hashes[1:n + 1] * np.uint64(P) + far)
        cls, member = item // MEMBERS, item % MEMBERS
        outer = np.stack([self.look.outer[0][one], self.look.outer[1][two], row_of(4, pair)])
        inner = np.stack([self.look.inner[0][cls, one], self.look.inner[1][cls, two]])
        return Batch(cls, member, outer, inner)


class Model(NamedTuple):
    """Biases (logarithms of counts) and hashed weights of the class softmax and of the member softmaxes."""
    class_bias: np.ndarray
    member_bias: np.ndarray
    outer: np.ndarray
    inner: np.ndarray


def untrained(mass: np.ndarray) -> Model:
    """The model of the counts alone. Unused items (mass 0) have no probability."""
    by = mass.reshape(CLASSES, MEMBERS).astype(np.float64)
    whole = by.sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        outer, member = np.log(whole / whole.sum()), np.log(by / whole[:, None])
    outer, member = (np.nan_to_num(x, nan=-1e9, neginf=-1e9).astype(np.float32) for x in (outer, member))
    return Model(outer, member, np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, MEMBERS), np.float32))


class Softmax:
    """Forward pass of one of the two softmaxes over up to PASS tokens, in memory that is used again."""

    def __init__(self, weights: np.ndarray):
        wide = weights.shape[1]
        self.weights, self.ones = weights, np.ones(wide, np.float32)
        self.sums, self.more = np.empty((PASS, wide), np.float32), np.empty((PASS, wide), np.float32)

    def pass_on(self, bias: np.ndarray, rows: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Natural logarithm of the target's probability, the exponentials of all outcomes and their sum."""
        n = len(target)
        x, y = self.sums[:n], self.more[:n]
        np.take(self.weights, rows[0], axis=0, out=x, mode="clip")
        x += bias
        for r in rows[1:]:
            np.take(self.weights, r, axis=0, out=y, mode="clip")
            x += y
        at = x[np.arange(n), target]
        np.exp(x, out=x)
        total = x @ self.ones
        return at - np.log(total), x, total


class Scorer:
    def __init__(self, model: Model):
        self.model, self.outer, self.inner = model, Softmax(model.outer), Softmax(model.inner)

    def log_probabilities(self, b: Batch) -> np.ndarray:
        """log10 of P(item | history) of every token of a batch."""
        out = np.empty(len(b.cls))
        for i in range(0, len(b.cls), PASS):
            s = slice(i, min(len(b.cls), i + PASS))
            out[s] = self.outer.pass_on(self.model.class_bias, b.outer[:, s], b.cls[s])[0]
            out[s] += self.inner.pass_on(self.model.member_bias[b.cls[s]], b.inner[:, s], b.member[s])[0]
        return out / np.log(10)


def odd_rows(rows: int, width: int, kind) -> np.ndarray:
    """An array whose rows don't begin a power of two apart, so that columns are read and written without cache conflicts."""
    return np.zeros((rows, width + 72), kind)[:, :width]


class Updates:
    """Gradient and weights of one softmax, outcome by outcome (``flipped``), with their sums of squares (AdaGrad)."""

    def __init__(self, start: np.ndarray):
        self.weights = start.copy()
        self.softmax = Softmax(self.weights)
        self.squares, self.gradient, self.spare, self.flipped = (odd_rows(start.shape[1], ROWS, np.float32) for _ in range(4))
        self.squares[:], self.flipped[:] = 1, start.T
        self.slope = odd_rows(start.shape[1], BATCH, np.float64)
        self.touched = np.zeros(ROWS, np.int64)

    def slopes(self, s: slice, bias: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
        _, p, total = self.softmax.pass_on(bias, rows, target)
        p *= (1 / total)[:, None]
        p[np.arange(len(target)), target] -= 1
        self.slope[:, s] = p.T

    def descend(self, rows: np.ndarray) -> None:
        n = rows.shape[1]
        for g, slope in zip(self.gradient, self.slope):
            g[:] = np.bincount(rows[0], weights=slope[:n], minlength=ROWS)
            for r in rows[1:]:
                g += np.bincount(r, weights=slope[:n], minlength=ROWS)
        for r in rows:
            self.touched += np.bincount(r, minlength=ROWS)
        g, x = self.gradient, self.spare
        np.multiply(g, g, out=x)
        self.squares += x
        np.sqrt(self.squares, out=x)
        g /= x
        g *= RATE
        self.flipped -= g
        np.clip(self.flipped, -LIMIT, LIMIT, out=self.flipped)
        self.weights[:] = self.flipped.T


class Learner:
    """Local updates of one task, from the round's weights, a batch at a time."""

    def __init__(self, model: Model):
        self.model, self.outer, self.inner, self.held, self.size = model, Updates(model.outer), Updates(model.inner), [], 0

    def learn(self, b: Batch) -> None:
        """Take in tokens; update the weights whenever they make a batch."""
        for i in range(0, len(b.cls), BATCH):
            part = b.part(slice(i, i + BATCH))
            if self.size + len(part.cls) > BATCH:
                self.update()
            self.held.append(part)
            self.size += len(part.cls)

    def update(self) -> None:
        if not self.size:
            return
        cls, member = (np.concatenate([getattr(b, f) for b in self.held]) for f in ("cls", "member"))
        outer, inner = (np.concatenate([getattr(b, f) for b in self.held], axis=1) for f in ("outer", "inner"))
        self.held, self.size = [], 0
        for i in range(0, len(cls), PASS):
            s = slice(i, min(len(cls), i + PASS))
            self.outer.slopes(s, self.model.class_bias, outer[:, s], cls[s])
            self.inner.slopes(s, self.model.member_bias[cls[s]], inner[:, s], member[s])
        self.outer.descend(outer)
        self.inner.descend(inner)


CHANGES = "part int, which int, block int, rows binary, counts binary, steps binary"


def changes(start: Model, learner: Learner, part: int) -> Iterator[pd.DataFrame]:
    """Touched weight rows, ``TOGETHER`` at a time: their counts and their changes."""
    out = []
    learner.update()
    for which, (old, new) in enumerate(((start.outer, learner.outer), (start.inner, learner.inner))):
        for block in range(ROWS // TOGETHER):
            rows = block * TOGETHER + np.flatnonzero(new.touched[block * TOGETHER:(block + 1) * TOGETHER])
            if len(rows):
                step = (new.weights[rows] - old[rows]).astype(np.float16)
                out.append((part, which, block, rows.astype(np.uint16).tobytes(), new.touched[rows].tobytes(), step.tobytes()))
    yield pd.DataFrame(out, columns=["part", "which", "block", "rows", "counts", "steps"])


def add_changes(group: pd.DataFrame) -> pd.DataFrame:
    """Average of the changes of one block's rows, weighed by their counts."""
    which, block = int(group["which"].iloc[0]), int(group["block"].iloc[0])
    wide = (CLASSES, MEMBERS)[which]
    counts, sums = np.zeros(TOGETHER, np.int64), np.zeros((TOGETHER, wide))
    for r, c, s in zip(group["rows"], group["counts"], group["steps"]):
        at, n = np.frombuffer(r, np.uint16) - block * TOGETHER, np.frombuffer(c, np.int64)
        counts[at] += n
        sums[at] += n[:, None] * np.frombuffer(s, np.float16).reshape(-1, wide).astype(np.float64)
    at = np.flatnonzero(counts)
    mean = (sums[at] / counts[at][:, None]).astype(np.float16)
    return pd.DataFrame([(0, which, block, (at + block * TOGETHER).astype(np.uint16).tobytes(), counts[at].tobytes(), mean.tobytes())],
                        columns=["part", "which", "block", "rows", "counts", "steps"])


def train(spark: SparkSession, texts: DataFrame, items: Items, rounds: int = ROUNDS) -> Model:
    """Weights after ``rounds`` rounds over ``texts(__llm_row, text)``, each document in one of them."""
    model = untrained(items.mass)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((model, items))

        def walk(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, known = shared.value
            learner, history = Learner(start), History()
            for batch in batches:
                for part in pieces([lowered(t.as_py()) for t in batch.column(0)], PIECE):
                    tokens = stream(part, known)
                    learner.learn(history.features(tokens.item, tokens.hash))
            for frame in changes(start, learner, TaskContext.get().partitionId()):
                yield pa.RecordBatch.from_pandas(frame, schema=pa.schema(
                    [("part", pa.int32()), ("which", pa.int32()), ("block", pa.int32()), ("rows", pa.binary()), ("counts", pa.binary()), ("steps", pa.binary())]),
                    preserve_index=False)

        mine = texts.where(F.pmod(F.xxhash64(ROW), F.lit(rounds)) == turn).select("text")
        found = mine.mapInArrow(walk, CHANGES)
        # two levels: a block's changes are added up FAN_IN tasks at a time
        found = found.groupBy("which", "block", (F.col("part") / FAN_IN).cast("int").alias("some")).applyInPandas(add_changes, CHANGES)
        found = found.groupBy("which", "block").applyInPandas(add_changes, CHANGES)
        outer, inner = model.outer.copy(), model.inner.copy()
        for r in found.toLocalIterator():  # at most 2 * ROWS / TOGETHER rows
            weights = (outer, inner)[r.which]
            weights[np.frombuffer(r.rows, np.uint16)] += np.frombuffer(r.steps, np.float16).reshape(-1, weights.shape[1])
        for weights in (outer, inner):
            np.clip(weights, -LIMIT, LIMIT, out=weights)
        model = model._replace(outer=outer, inner=inner)
    return model


# ---------------------------------------------------------------- counts, items, scores
def choose_items(counts: DataFrame, ends: int) -> tuple[Items, np.ndarray, np.ndarray]:
    """The items, and for each bin the tokens and the kinds of tokens in it."""
    plain = counts.where(F.col("token") != END)
    frequent = plain.orderBy(F.desc("n"), "token").limit(WORDS - 1).toArrow()
    token, tail = (frequent[c].to_numpy().view(np.uint64) for c in ("token", "tail"))
    bins, n = frequent["bin"].to_numpy(), frequent["n"].to_numpy()
    mass, tokens, kinds = np.zeros(CLASSES * MEMBERS, np.int64), np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    for r in plain.groupBy("bin").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():  # BINS rows at most
        tokens[r.bin], kinds[r.bin] = r.n, r.kinds
    np.subtract.at(tokens, bins, n)
    np.subtract.at(kinds, bins, 1)
    order = np.lexsort((token, tail))  # words of like endings share a class
    mass[END_ITEM], mass[WORDS:] = ends + 1, tokens + 1  # unseen tokens need a bin of some mass
    mass[1:len(n) + 1] = n[order]
    number = np.empty(len(n), np.int64)
    number[order] = np.arange(1, len(n) + 1)
    rank = np.argsort(token)
    return Items(token[rank], number[rank], mass), tokens, kinds


def score(spark: SparkSession, docs: DataFrame, hot: int = HOT, rounds: int = ROUNDS) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)``, whole texts; learned from the documents that are not held out.

    Columns ``__llm_row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. Null and empty texts are one token, the
    end. Documents with a null id are scored, not learned from, and not held out. Repeated rows count each, in learning too. With nothing
    to learn from no token is known and every item that an unseen token can have is equally likely. An empty table gives no rows.
    """
    rows = with_row(docs.select("doc_id", "text")).select(ROW, "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    learned = rows.where(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    counts = materialize(spark, token_counts(learned).withColumn("value", F.log10(F.col("n") + 1)), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds"),
                       F.coalesce(F.max(F.when(F.col("token") == END, F.col("n"))), F.lit(0)).alias("ends")).first()
    items, bin_tokens, bin_kinds = choose_items(counts, total.ends)
    model = train(spark, learned, items, rounds)
    cut = hot_cut(counts, hot)
    known = counts.where((F.col("n") >= cut) & (F.col("token") != END)).select("token", "value").toArrow()
    hashes, values = known["token"].to_numpy().view(np.uint64), known["value"].to_numpy()
    shares = np.log10(bin_tokens + bin_kinds + 1.0)
    unit = float(np.log10(total.tokens + total.kinds + 1.0))
    ends = (float(np.log10(total.ends + 1.0)), bool(total.ends))
    shared = spark.sparkContext.broadcast((model, items, hashes, values, shares))
    del known

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known, hashes, values, shares = shared.value
        history, scorer, frequent = History(), Scorer(weights), Frequent(hashes, values)
        for batch in batches:
            n = batch.num_rows
            tokens, seen, base, own = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            left: list[tuple[np.ndarray, ...]] = []
            for part in pieces([lowered(t.as_py()) for t in batch.column(3)], PIECE):
                s = stream(part, known)
                logs = scorer.log_probabilities(history.features(s.item, s.hash))
                in_bin = s.item >= WORDS
                logs[in_bin] -= shares[s.item[in_bin] - WORDS]
                own += np.bincount(s.doc, weights=logs, minlength=n)
                tokens += np.bincount(s.doc, minlength=n)
                at_end = s.item == END_ITEM
                base += ends[0] * np.bincount(s.doc[at_end], minlength=n)
                seen += ends[1] * np.bincount(s.doc[at_end], minlength=n)
                hit, value = frequent.find(s.hash[s.place])
                doc, binned = s.doc[s.place], in_bin[s.place]
                base += np.bincount(doc, weights=value, minlength=n)
                seen += np.bincount(doc[hit], minlength=n)
                own += np.bincount(doc, weights=value * binned, minlength=n)
                left.append((doc[~hit], s.hash[s.place][~hit], binned[~hit]))
            # documents come in order, so each one's tokens lie together
            doc, cold, binned = (np.concatenate(x) for x in zip(*left)) if left else (np.zeros(0, t) for t in (np.int64, np.uint64, bool))
            upto = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(upto, pa.array(x)) for x in (cold.view(np.int64), binned)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(tokens), pa.array(seen), pa.array(base), pa.array(own), *lists],
                [ROW, "doc_id", "held_out", "n_tokens", "seen", "base", "own", "tokens", "binned"])

    ident = rows.schema["doc_id"].dataType.simpleString()
    partly = materialize(spark, rows.mapInArrow(
        walk, f"{ROW} long, doc_id {ident}, held_out boolean, n_tokens long, seen long, base double, own double, tokens array<long>, binned array<boolean>"), "lm-docs")
    cold = partly.select(ROW, F.explode(F.arrays_zip("tokens", "binned")).alias("t")).select(ROW, F.col("t.tokens").alias("token"), F.col("t.binned").alias("binned"))
    more = cold.join(counts.select("token", "value"), "token").groupBy(ROW).agg(F.count("*").alias("more_seen"), F.sum("value").alias("more_base"),
                                                     F.sum(F.when(F.col("binned"), F.col("value")).otherwise(0.0)).alias("more_own"))
    zero = F.lit(0.0)
    return partly.drop("tokens", "binned").join(more, ROW, "left").select(
        ROW, "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("more_seen", F.lit(0))).alias("n_known"),
        F.lit(total.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("own") + F.coalesce("more_own", zero)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text of ``documents``."""
    return score(spark, table(spark, sf_dir, "documents")).drop(ROW)
