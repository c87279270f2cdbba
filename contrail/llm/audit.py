"""Filter interaction audit: what every order of the quality filters would keep, remove and waste.

Five filters give each document a mask of the filters that it fails. Documents are counted by part
and mask; every such cell folds over the array of all 120 orders (one literal that travels with the
task) with ``transform`` and ``aggregate`` and yields 600 structs, one per order and step, weighted
by the cell's counts. The structs of a part's cells (32 at most) are merged by elementwise sums.

Nothing but ids, digests and masks is shuffled. Whether a document repeats one of smaller id is told
by joining on (digest, id) with the smallest id of each digest: that key is one row on either side,
so a group of copies of any size is spread over all tasks.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import table
from contrail.session import materialize

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FEW_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
CAPITALS = "[A-Z]"
SYMBOLS = "[#$%&*|]"
COUNTS = ["n", "good", "toxic"]
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def zero() -> Column:
    return F.lit(0).cast("long")


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a non-null text fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    fails = [
        F.size(words) < FEW_WORDS,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
        F.regexp_count(text, F.lit(CAPITALS)) * 100 > F.length(text) * CAPITALS_PERCENT,
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masks(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic`` of every row of ``docs(doc_id, text, lang)``; bit i of the mask: fails the i-th filter.

    ``labels(doc_id, quality, toxic)``: a document is good (toxic) if any of its label rows says so; labels of no document and
    documents without labels are neither. Null text is the empty text. A null id is no smaller than any id and no id is smaller
    than it, so such a row never fails E nor makes another fail. Rows that repeat an id and its text fail E only if a smaller id
    has the text too.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text")).select(
        "doc_id", "part", text_mask(F.col("text")).alias("own"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    rows = materialize(spark, rows, "audit-rows")  # every text is read and split once
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"))
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(first.select(F.col("digest").alias("first_digest"), "first"),
                     (F.col("digest") == F.col("first_digest")) & (F.col("doc_id") == F.col("first")), "left")
    rows = rows.join(known.withColumnRenamed("doc_id", "labelled"), F.col("doc_id") == F.col("labelled"), "left")
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.select("part", (F.col("own") + F.when(repeats, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"),
                       F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def steps(mask: Column, weights: dict[str, Column], orders: list[str] = ORDERS) -> Column:
    """Array of one struct per order and step: what one cell of documents with this mask adds to it."""
    def walk(order: Column) -> Column:
        # the state: bits of the filters already applied, and the steps so far
        def step(state: Column, bit: Column) -> Column:
            fails = mask.bitwiseAND(bit) != 0
            before = mask.bitwiseAND(state["applied"]) != 0
            gone = fails & ~before
            applied = state["applied"].bitwiseOR(bit)
            here = F.struct(
                F.when(mask.bitwiseAND(applied) == 0, weights["n"]).otherwise(zero()).alias("kept"),
                F.when(gone, weights["n"]).otherwise(zero()).alias("removed"),
                F.when(fails & before, weights["n"]).otherwise(zero()).alias("redundant"),
                F.when(mask == bit, weights["n"]).otherwise(zero()).alias("unique_fails"),
                F.when(gone, weights["good"]).otherwise(zero()).alias("good_lost"),
                F.when(gone, weights["toxic"]).otherwise(zero()).alias("toxic_lost"))
            return F.struct(applied.alias("applied"), F.concat(state["steps"], F.array(here)).alias("steps"))

        none = F.expr("cast(array() as array<struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">>)")
        return F.aggregate(order, F.struct(F.lit(0).alias("applied"), none.alias("steps")), step, lambda state: state["steps"])

    bits = [[1 << FILTERS.index(f) for f in order] for order in orders]
    return F.flatten(F.transform(F.lit(bits), walk))


def added(a: Column, b: Column) -> Column:
    """Elementwise sums of two arrays of steps."""
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[m] + y[m]).alias(m) for m in MEASURES]))


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: ``part, filter_order, step`` and the counts.

    ``shapley``: what the step's filter removes, summed over all orders. Rows as ``masks`` tells; empty ``docs``: no rows.
    """
    cells = masks(spark, docs, labels).groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))
    folded = cells.select("part", steps(F.col("mask"), {c: F.col(c) for c in COUNTS}).alias("steps"))
    # a part has a cell per mask: 32 arrays at most
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", F.aggregate(
        F.slice("cells", 2, 1 << len(FILTERS)), F.element_at("cells", 1), added).alias("steps"))
    merged = merged.select("part", F.transform("steps", lambda s, i: F.struct(
        F.element_at(F.lit(ORDERS), (F.floor(i / len(FILTERS)) + 1).cast("int")).alias("filter_order"),
        (i % len(FILTERS) + 1).cast("int").alias("step"), *[s[m].alias(m) for m in MEASURES])).alias("steps"))

    def letter(s: Column) -> Column:
        return s["filter_order"].substr(s["step"], F.lit(1))

    def share(f: str) -> Column:
        return F.aggregate("steps", zero(), lambda total, s: total + F.when(letter(s) == f, s["removed"]).otherwise(zero()))

    own = F.col("s")
    shares = F.create_map(*[x for f in FILTERS for x in (F.lit(f), share(f))])
    return merged.withColumn("shares", shares).select("part", "shares", F.explode("steps").alias("s")).select(
        "part", *[own[c].alias(c) for c in ("filter_order", "step", *MEASURES)], F.element_at("shares", letter(own)).alias("shapley"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of ``documents`` with its ``labels``."""
    return audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
rows AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
first AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT r.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
         [len(r.words) < 200, 100 * len(list_distinct(r.words)) < 50 * len(r.words),
          100 * (length(r.text) - length(regexp_replace(r.text, '[A-Z]', '', 'g'))) > 3 * length(r.text),
          regexp_matches(r.text, '[#$%&*|]'), coalesce(r.doc_id > f.first, false)] AS fails
  FROM rows r JOIN first f ON f.text = r.text LEFT JOIN known k ON k.doc_id = r.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(o, l)),
places AS (SELECT o AS filter_order, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5),
walked AS (
  SELECT c.part, p.filter_order, p.step, c.n, c.good, c.toxic, c.fails[ascii(p.filter_order[p.step]) - 64] AS hit,
         len(list_filter(range(1, p.step), lambda s: c.fails[ascii(p.filter_order[s]) - 64])) > 0 AS earlier,
         len(list_filter(c.fails, lambda f: f)) = 1 AS single
  FROM cells c, places p),
summed AS (
  SELECT part, filter_order, step, filter_order[step] AS letter, sum(CASE WHEN NOT hit AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN hit AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN hit AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN hit AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN hit AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN hit AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM walked GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed
"""
