"""N-gram Jaccard join in a metric space: pivots, Voronoi regions, triangle-inequality windows, recursion; exact.

A document is the set of its distinct five-word shingles. Jaccard distance is a
metric, but pivots drawn at random see nearly every text at distance exactly 1,
where the triangle inequality prunes nothing. The regions are therefore seeded
from what can be near at all:

1. Two sets of similarity ``t`` share at least ``t`` of their shingles. Exact
   document frequencies (exchanged between blocks as packed arrays) drop every
   set of which fewer occur elsewhere, and order shingles from rare to common.
2. In that order, linked sets share a shingle within their first
   ``n - ceil(t n) + 1``. For each such shingle the member with the most shared
   ones is the pivot, and all members join the pivot's region: one row per
   (pivot, member), however many shingles led there.
3. A region larger than ``CAP`` is split between tasks: ``PIVOTS`` members become
   pivots, each member goes to its nearest and, as a guest, to every other one
   within the triangle-inequality window ``d(x, q) - d(x, p) <= 2 (1 - t)``.
   Inside a task regions go on splitting that way down to ``LEAF`` members,
   whose similarities are computed exactly. Regions that the windows cannot
   split (all members near each other) are compared in blocks.
4. Links leave a region as a star per connected group, and min-label rounds
   over written tables join the groups.

Equal sets are one class from the second step on, so copies cost one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import blocks as B
from contrail.llm.common import ROW, own_names, table, with_row
from contrail.session import materialize

SHINGLE = 5
#: Similarity threshold as a ratio of whole numbers, so that ties at 0.8 are decided exactly.
NEAR = (80, 100)
LEAF = 64
CAP = 4096
PIVOTS = 16
#: Members of a large region measured in one group.
CELL = 512
COLUMNS = 4096


def shingles(text: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's bytes (A-Z lower-cased); fewer words make one shingle."""
    data = B.LOWER[text]
    begin, end = B.words(data)
    if not len(begin):
        return np.zeros(0, np.uint64)
    hashes = B.word_hashes(data, begin, end)
    if len(hashes) < size:
        return B.mix(B.rolling(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(B.rolling(hashes, size))


def signature(values: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    a = B.mix(values).sum(dtype=np.uint64)
    b = B.mix(values ^ np.uint64(B.P)).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(values))], np.uint64).tobytes()


def needed(n, near=NEAR):
    """Smallest number of its ``n`` shingles that a set shares with a linked one."""
    return -(-near[0] * n // near[1])


class Block:
    """Rows of a block with their shingle sets; ``first`` marks the first row of each distinct set."""

    def __init__(self, rows: pa.Table):
        self.rows = B.by_row(rows)
        self.sets = [shingles(np.frombuffer(v.as_buffer(), np.uint8)) for v in self.rows["text"]]
        self.signatures = [signature(s) if len(s) else None for s in self.sets]
        seen: set = {None}
        self.first = []
        for s in self.signatures:
            self.first.append(s not in seen)
            seen.add(s)
        own = [s for s, f in zip(self.sets, self.first) if f]
        short = B.shorten(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        self.hashes, self.counts = np.unique(short, return_counts=True)


def frequency_class(counts: np.ndarray) -> np.ndarray:
    """0 for a shingle in one set only, else 1 to 255 growing with the logarithm of its frequency."""
    return np.where(counts > 1, np.minimum(255, 8 * np.log2(np.maximum(counts, 2)) - 7), 0).astype(np.uint8)


def survivors(spark: SparkSession, docs: DataFrame, columns: list, near=NEAR, block_bytes: int = B.BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The blocks, and a written table ``__llm_row, doc_id, n, signature, prefix, shared``.

    ``shared`` packs the shingles of a row that occur in other sets, ``prefix`` those among them that
    a linked set must meet; both null for rows that cannot be linked to a different set, or whose set an
    earlier row of the block has.
    """
    rows, bucket_keys = B.blocked(spark, docs, columns, block_bytes)
    buckets = len(bucket_keys)

    def send(key: tuple, block: pa.Table) -> pa.Table:
        own = Block(block)
        parts = B.split(own.hashes, buckets)
        return pa.table({"bucket": pa.array([bucket_keys[p[0]] for p in parts], pa.int32()), "block": pa.array([key[0].as_py()] * len(parts), pa.int32()),
                         "first": pa.array([int(own.hashes[a]) for _, a, _ in parts], pa.int64()), "hashes": pa.array([B.pack(own.hashes[a:b]) for _, a, b in parts], pa.binary()),
                         "counts": pa.array([np.minimum(own.counts[a:b], 65535).astype(np.uint16).tobytes() for _, a, b in parts], pa.binary())})

    def answer(key: tuple, got: pa.Table) -> pa.Table:
        held = [B.unpack(v.as_buffer()) for v in got["hashes"]]
        counts = [np.frombuffer(v.as_buffer(), np.uint16) for v in got["counts"]]
        every, where = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts), len(every))
        classes = np.split(frequency_class(total)[where], np.cumsum([len(h) for h in held])[:-1])
        return pa.table({"block": got["block"].combine_chunks(), "first": got["first"].combine_chunks(),
                         "classes": pa.array([c.tobytes() for c in classes], pa.binary())})

    def choose(key: tuple, block: pa.Table, letters: pa.Table) -> pa.Table:
        own = Block(block)
        letters = letters.sort_by("first")  # buckets are ranges: in order of their first hash they make up the sorted array
        classes = np.concatenate([np.frombuffer(v.as_buffer(), np.uint8) for v in letters["classes"]] or [np.zeros(0, np.uint8)])
        prefixes, shared = [], []
        for values, first in zip(own.sets, own.first):
            prefix = some = None
            if first:
                n, rank = len(values), classes[np.searchsorted(own.hashes, B.shorten(values))]
                some = values[rank > 0]
                if len(some) >= needed(n, near):
                    order = np.lexsort((values, rank))[:n - needed(n, near) + 1]
                    prefix = values[order[rank[order] > 0]].astype(np.int64)
                else:
                    some = None
            prefixes.append(prefix)
            shared.append(None if some is None else some.tobytes())
        got = own.rows.select([ROW, "doc_id"])
        for name, values in (("n", pa.array([len(s) for s in own.sets], pa.int64())), ("signature", pa.array(own.signatures, pa.binary())),
                             ("prefix", pa.array(prefixes, pa.list_(pa.int64()))), ("shared", pa.array(shared, pa.binary()))):
            got = got.append_column(name, values)
        return got

    sent = rows.groupBy("block").applyInArrow(send, "bucket int, block int, first long, hashes binary, counts binary").repartition(buckets, "bucket")
    mail = sent.groupBy("bucket").applyInArrow(answer, "block int, first long, classes binary")
    out = rows.select(ROW, "doc_id", "text", "block").groupBy("block").cogroup(mail.groupBy("block")).applyInArrow(
        choose, f"{ROW} long, doc_id long, n long, signature binary, prefix array<long>, shared binary")
    return rows, materialize(spark, out, "jaccard-sets")


class Members:
    """Sets of a region as ranks in its vocabulary of shared shingles, with full sizes."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, near=NEAR):
        self.near, self.sizes = near, sizes
        every, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.cumsum(counts > 1) - 1
        use = counts[where] > 1
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[use]
        column = rank[where][use]
        order = np.lexsort((column, owner))
        self.column = column[order]
        self.edge = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sets)))))

    def overlaps(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Intersection sizes of two lists of members, over the shingles both lists have, in bounded blocks of columns."""
        a, b = (np.concatenate([self.column[self.edge[i]:self.edge[i + 1]] for i in x] or [self.column[:0]]) for x in (rows, others))
        of_a, of_b = (np.repeat(np.arange(len(x)), self.edge[x + 1] - self.edge[x]) for x in (rows, others))
        both = np.intersect1d(a, b)
        out = np.zeros((len(rows), len(others)), np.float32)
        if not len(both):
            return out
        place = []
        for column, of in ((a, of_a), (b, of_b)):
            at = np.minimum(np.searchsorted(both, column), len(both) - 1)
            hit = both[at] == column
            place.append((at[hit], of[hit]))
        for start in range(0, len(both), COLUMNS):
            piece = []
            for (at, of), size in zip(place, (len(rows), len(others))):
                inside = (at >= start) & (at < start + COLUMNS)
                m = np.zeros((size, min(COLUMNS, len(both) - start)), np.float32)
                m[of[inside], at[inside] - start] = 1
                piece.append(m)
            out += piece[0] @ piece[1].T
        return out

    def linked(self, rows: np.ndarray, others: np.ndarray, shared: np.ndarray) -> np.ndarray:
        union = self.sizes[rows][:, None] + self.sizes[others][None, :] - shared
        return self.near[1] * shared >= self.near[0] * union

    def distances(self, rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = self.overlaps(rows, pivots)
        union = self.sizes[rows][:, None] + self.sizes[pivots][None, :] - shared
        return 1 - shared / np.maximum(union, 1), self.linked(rows, pivots, shared)


class Groups:
    """Union-find over the members of a region."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def window(distances: np.ndarray, near=NEAR) -> np.ndarray:
    """Members x pivots: the nearest pivot, and every other one whose region a linked set may lie in."""
    return distances <= distances.min(axis=1, keepdims=True) + 2 * (1 - near[0] / near[1]) + 1e-6


def join_region(members: Members, rows: np.ndarray, groups: Groups, leaf: int = LEAF) -> None:
    """Put every two linked members of a region into one group, exactly."""
    rows = rows[np.argsort(members.sizes[rows], kind="stable")]
    if len(rows) > leaf:
        pivots = rows[:: -(-len(rows) // PIVOTS)]
        distance, linked = members.distances(rows, pivots)
        for i, j in zip(*np.nonzero(linked)):
            groups.join(int(rows[i]), int(pivots[j]))
        regions = [rows[w] for w in window(distance, members.near).T]
        if max(map(len, regions)) <= 0.7 * len(rows):
            for r in regions:
                join_region(members, r, groups, leaf)
            return
    # In blocks. Rows the pivots put into one group need no comparison with each other, only the rest with all.
    roots = np.array([groups.root(int(i)) for i in rows])
    value, count = np.unique(roots, return_counts=True)
    rest = rows[roots != value[count.argmax()]] if count.max() > 1 else rows
    sizes = members.sizes[rows]
    for at in range(0, len(rest), leaf):  # in order of size, so partners begin and end where sizes differ too much
        part = rest[at:at + leaf]
        low, high = members.sizes[part[0]] * members.near[0] / members.near[1], members.sizes[part[-1]] * members.near[1] / members.near[0]
        others = rows[np.searchsorted(sizes, low - 1):np.searchsorted(sizes, high + 1, "right")]
        for start in range(0, len(others), 1024):
            other = others[start:start + 1024]
            for i, j in zip(*np.nonzero(members.linked(part, other, members.overlaps(part, other)))):
                groups.join(int(part[i]), int(other[j]))


def links(spark: SparkSession, sets: DataFrame, near=NEAR, cap: int = CAP, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between rows of ``sets(row, n, prefix, shared)`` that connect exactly what similarity connects."""
    posts = sets.select("row", F.size("prefix").alias("many"), F.explode("prefix").alias("s"))
    pivots = posts.groupBy("s").agg(F.max(F.struct("many", F.col("row").alias("pivot"))).alias("p"), F.count("*").alias("members")).where("members > 1")
    region = posts.join(pivots.select("s", F.col("p.pivot").alias("pivot")), "s").select("pivot", "row").distinct()
    region = materialize(spark, region, "jaccard-regions").join(sets.select("row", "n", "shared"), "row")
    region = region.select(F.col("pivot").cast("string").alias("region"), "row", "n", "shared")
    region, direct = split_large(spark, region, near, cap)

    def solve(got: pa.Table) -> pa.Table:
        rows = got["row"].to_numpy()
        order = np.argsort(rows)
        rows, sizes = rows[order], got["n"].to_numpy()[order].astype(np.float64)
        held = got["shared"].combine_chunks()
        values = [np.frombuffer(held[int(i)].as_buffer(), np.uint64) for i in order]
        groups = Groups(len(rows))
        join_region(Members(values, sizes, near), np.arange(len(rows)), groups, leaf)
        root = np.array([groups.root(i) for i in range(len(rows))])
        tied = np.flatnonzero(root != np.arange(len(rows)))
        return pa.table({"a": pa.array(rows[tied], pa.int64()), "b": pa.array(rows[root[tied]], pa.int64())})

    found = region.groupBy("region").applyInArrow(solve, "a long, b long")
    return found if direct is None else found.unionByName(direct)


def split_large(spark: SparkSession, region: DataFrame, near, cap: int) -> tuple[DataFrame, DataFrame | None]:
    """Regions of at most about ``cap`` members that bring the same pairs together, and links found on the way.

    Voronoi regions with triangle-inequality windows, again for those still too large. A region that
    gets no smaller has its members near each other: those linked to its best pivot are connected by it
    and form the core; only the others must meet all members, in regions of two chunks of ``cap / 2``.
    """
    sizes = materialize(spark, region.groupBy("region").count().where(F.col("count") > cap).select(
        F.col("region").alias("large"), F.col("count").alias("members")), "jaccard-large")
    if sizes.isEmpty():
        return region, None
    region = materialize(spark, region, "jaccard-split")
    small = region.join(sizes, F.col("region") == F.col("large"), "left_anti")
    large = region.join(sizes, F.col("region") == F.col("large")).drop("large")
    keyed = large.withColumn("h", F.xxhash64("row", F.lit(7)))
    one = keyed.groupBy("region", "members", F.pmod("h", F.lit(PIVOTS)).alias("class")).agg(F.min_by(F.struct("row", "n", "shared"), "h").alias("p"))
    # members of a region are measured in cells, so a hot region spreads over tasks; its pivots go to each cell
    cells = F.ceil(F.col("members") / CELL)
    cell = F.concat_ws("~", F.col("region"), F.pmod(F.xxhash64("row"), cells))
    every = F.explode(F.sequence(F.lit(0).cast("long"), cells - 1))
    pivots = one.withColumn("c", every).select(F.concat_ws("~", "region", "c").alias("cell"), F.col("class").cast("int").alias("class"), "p.row", "p.n", "p.shared")
    pivots = materialize(spark, pivots, "jaccard-pivots")

    def measure(mine: pa.Table, held: pa.Table) -> pa.Table:
        held = held.sort_by("class")
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in held["shared"]]
        sizes_, names, rows = held["n"].to_numpy(), held["class"].to_numpy(), held["row"].to_numpy()
        to, linked = [], []
        for own, n in zip(mine["shared"], mine["n"].to_pylist()):
            own = np.frombuffer(own.as_buffer(), np.uint64)
            shared = np.array([len(np.intersect1d(own, s, assume_unique=True)) for s in sets], np.int64)
            union = n + sizes_ - shared
            to.append(names[window((1 - shared / np.maximum(union, 1))[None, :], near)[0]].tolist())
            linked.append(rows[near[1] * shared >= near[0] * union].tolist())
        return pa.table({"region": mine["region"], "row": mine["row"], "n": mine["n"], "shared": mine["shared"], "members": mine["members"],
                         "to": pa.array(to, pa.list_(pa.int32())), "linked": pa.array(linked, pa.list_(pa.int64()))})

    placed = large.withColumn("cell", cell).groupBy("cell").cogroup(pivots.groupBy("cell")).applyInArrow(
        measure, "region string, row long, n long, shared binary, members long, to array<int>, linked array<long>")
    placed = materialize(spark, placed, "jaccard-placed")
    largest = (placed.select("region", "members", F.explode("to").alias("to")).groupBy("region", "members", "to").count()
               .groupBy("region", "members").agg(F.max("count").alias("largest")))
    best = (placed.select("region", F.explode("linked").alias("pivot")).groupBy("region", "pivot").count()
            .groupBy("region").agg(F.max(F.struct("count", "pivot")).alias("b")).select(F.col("region").alias("at"), "b.*"))
    fate = materialize(spark, largest.join(best, F.col("region") == F.col("at"), "left").select(
        F.col("region").alias("of"), (F.col("largest") <= 0.7 * F.col("members")).alias("smaller"), "pivot",
        F.coalesce("count", F.lit(0)).alias("core")), "jaccard-fate")
    placed = placed.join(fate, F.col("region") == F.col("of"))
    going = placed.where("smaller").withColumn("next", F.explode("to")).select(
        F.concat_ws("/", "region", "next").alias("region"), "row", "n", "shared")
    stuck = placed.where("not smaller").withColumn("inner", F.coalesce(F.array_contains("linked", F.col("pivot")), F.lit(False)))
    direct = stuck.where("inner").select(F.col("row").alias("a"), F.col("pivot").alias("b"))
    outer_chunks, core_chunks = F.ceil(2 * (F.col("members") - F.col("core")) / cap), F.ceil(2 * F.col("core") / cap)
    chunk = F.pmod(F.xxhash64("row"), F.greatest(F.lit(1), F.when(F.col("inner"), core_chunks).otherwise(outer_chunks)))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    among = F.transform(upto(outer_chunks), lambda c: F.concat_ws("x", F.least(c, chunk).cast("string"), F.greatest(c, chunk).cast("string")))
    across = F.transform(upto(core_chunks), lambda c: F.concat_ws("y", chunk.cast("string"), c.cast("string")))
    from_core = F.transform(upto(outer_chunks), lambda c: F.concat_ws("y", c.cast("string"), chunk.cast("string")))
    meets = stuck.withColumn("pair", F.explode(F.when(F.col("inner"), from_core).otherwise(F.concat(among, across))))
    chunked = meets.select(F.concat_ws("#", "region", "pair").alias("region"), "row", "n", "shared")
    done = small.unionByName(chunked)
    if fate.where("smaller").isEmpty():
        return done, direct
    more, found = split_large(spark, going, near, cap)
    return done.unionByName(more), direct if found is None else direct.unionByName(found)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: the smallest node it is connected to, by large and small stars over written tables."""
    edges = materialize(spark, edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(spark, large, "star-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        small = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        small = materialize(spark, small.where("a != b").distinct(), "star-small")
        digest = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        if small.agg(*digest).first() == edges.agg(*digest).first():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = small


def classes(spark: SparkSession, docs: DataFrame, columns: list | None = None, near=NEAR, cap: int = CAP, leaf: int = LEAF,
            block_bytes: int = B.BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The blocks, and ``__llm_row, doc_id, n_shingles, component_id, keep`` for every row of ``docs(doc_id, text)``.

    Rows link when their sets' similarity reaches ``near``; ``component_id`` is the smallest doc_id
    reachable by links, the row's own included (null if all are), ``keep`` marks one row per component:
    that of smallest id, then scan order. Null and word-less texts have the empty set, link with
    nothing and are kept. Rows of one id are rows of their own; equal sets always link.
    """
    own_id = F.col("doc_id").cast("long").alias("doc_id")
    rows, found = survivors(spark, docs, [own_id, *(columns or [])], near, block_bytes)
    # one set per signature goes on: the rows of a signature hold the same shingles, prefix included
    sets = found.where("prefix is not null").groupBy("signature").agg(F.min(ROW).alias("row"))
    sets = found.join(sets.withColumnRenamed("signature", "of"), F.col(ROW) == F.col("row")).select("row", "n", "signature", "prefix", "shared")
    sets = materialize(spark, sets, "jaccard-classes")
    tied = components(spark, links(spark, sets, near, cap, leaf))
    grouped = sets.select("row", "signature").join(tied, F.col("row") == F.col("node"), "left").select(
        F.col("signature").alias("of"), F.coalesce("root", "row").cast("string").alias("root"))  # a root is no node of its own star
    grouped = materialize(spark, grouped, "jaccard-grouped")
    label = F.when(F.col("n") == 0, F.concat_ws(":", F.lit("row"), F.col(ROW))).otherwise(F.coalesce("root", F.hex("signature")))
    labelled = found.select(ROW, "doc_id", "n", "signature").join(grouped, F.col("signature") == F.col("of"), "left").select(
        ROW, "doc_id", "n", label.alias("label"))
    labelled = materialize(spark, labelled, "jaccard-labels")
    heads = labelled.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(ROW).alias("row"))).alias("head"))
    heads = materialize(spark, heads, "jaccard-heads")  # written: the join below is a plain one, whose hot labels can be split
    out = labelled.join(heads, "label").select(ROW, "doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"),
                                               (F.col("head.row") == F.col(ROW)).alias("keep"))
    return rows, out


@own_names
def distinct_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One document of each component of ``docs``, in its own columns."""
    _, found = classes(spark, docs, **options)
    gone = materialize(spark, found.where("not keep").select(F.col(ROW).alias("__gone")), "jaccard-gone")
    rows = with_row(docs)
    return rows.join(gone, rows[ROW] == gone["__gone"], "left_anti").select(*[rows[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark, table(spark, sf_dir, "documents"))[1].select("doc_id", "n_shingles", "component_id")
