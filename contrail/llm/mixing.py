"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source_size`` copies. Walking the
documents of a source in order of size, the running sum of expected copies plus
one random offset crosses integers; a document is emitted once per integer it
crosses. Ordering by size keeps the words taken within one document of the
target, whatever the sizes are.

The running sum needs each document's rank in its source. A window per source
would put a source with a third of all rows into one task, so the (text-free)
rows are range-partitioned by (source, size, key), ranked inside each partition
by position, and shifted by per-(partition, source) counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import ROW, own_names, with_row
from contrail.session import materialize

#: Words are runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Target words per source from ``sizes(source, source_size)``, one row per source.

    Sources in code-point order, null last, take ``weights`` in turn. All words
    are shared by weight; a target stops at ``max_repeat`` times its source's
    size and the excess goes to the others by weight, until none is above.
    The stopped sources are a prefix in order of cap / weight, so one running
    sum over the (one row per source) table finds them exactly.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    dec = "decimal(19,0)"
    return (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("full", F.col("cap").cast(dec) * (F.col("weights") - F.col("weight_before")).cast(dec)
                    <= F.col("weight").cast(dec) * (F.col("total") - F.col("cap_before")).cast(dec))
        .withColumn("left", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0)))
        .withColumn("open", F.col("weights")
                    - F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(everything), F.lit(0)))
        .select("source", "source_size", "weight",
                F.when(F.col("full"), F.col("cap").cast("double"))
                .otherwise((F.col("weight") * F.col("left")).cast("double") / F.col("open").cast("double")).alias("target"))
    )


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 17) -> DataFrame:
    """One row per document of ``docs(doc_id, text, source)``: its size in words and how often the mix takes it.

    Columns ``__llm_row, doc_id, source, size, source_size, target, copies, taken``.
    Null text has size 0; null source is a source of its own, sorted last; documents of equal
    size are ordered by a digest of their id, so reruns agree; repeated rows count each.
    A source without words has target 0. Empty input gives an empty result.
    """
    key = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    sized = with_row(docs.select("doc_id", "text", "source")).select(
        ROW, "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"))
    placed = (
        sized.repartitionByRange("source", "size", "key", ROW).sortWithinPartitions("source", "size", "key", ROW)
        .withColumn("at", F.monotonically_increasing_id())
        .select(ROW, "doc_id", "source", "size", "at", F.shiftright("at", 33).cast("int").alias("part"))
    )
    placed = materialize(spark, placed, "mix-placed")  # the ranges are sampled: both uses must see the same ones
    cells = placed.groupBy("part", "source").agg(F.count("*").alias("rows"), F.min("at").alias("first"), F.sum("size").alias("words"))
    cells = materialize(spark, cells, "mix-cells")
    goal = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    goal = goal.withColumnRenamed("source", "goal_source")
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("\x01"))).cast("binary")), 1, 8),
                    16, 10).cast("double") / F.lit(4294967296.0)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        cells.withColumn("ahead", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
        .select(F.col("part").alias("cell_part"), F.col("source").alias("cell_source"), "ahead", "first", "source_size", "target",
                offset.alias("offset"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    crossed = (F.floor(F.col("offset") + F.col("rank") * F.col("rate"))
               - F.floor(F.col("offset") + (F.col("rank") - 1) * F.col("rate")))
    return (
        placed.join(cells, (F.col("part") == F.col("cell_part")) & F.col("source").eqNullSafe(F.col("cell_source")))
        .withColumn("rank", F.col("ahead") + F.col("at") - F.col("first") + 1)
        .withColumn("rate", rate)
        .withColumn("copies", F.least(crossed, F.lit(max_repeat)).cast("long"))
        .select(ROW, "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


@own_names
def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document of ``docs`` as often as it is taken, with its copy number as ``mix_copy`` (last column, in place of an input column of that name)."""
    taken = mix(spark, docs, **options).where("copies > 0").select(F.col(ROW).alias("__taken"), "copies")
    rows = with_row(docs)
    joined = rows.join(taken, rows[ROW] == taken["__taken"])
    copy = F.explode(F.sequence(F.lit(1).cast("long"), taken["copies"]))
    return joined.select(*[rows[c] for c in docs.columns if c != "mix_copy"], copy.alias("mix_copy"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.common import table
    return mix(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         coalesce(md5(doc_id::VARCHAR), '') AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM sources),
running AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER r, 0) AS cap_before, coalesce(sum(weight) OVER r, 0) AS weight_before
  FROM weighted
  WINDOW r AS (ORDER BY cap::DOUBLE / weight, weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, cap * (weights - weight_before) <= weight * (total - cap_before) AS is_full FROM running),
remaining AS (
  SELECT *, total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS words_left,
         weights - coalesce(sum(CASE WHEN is_full THEN weight END) OVER (), 0) AS open FROM stopped),
goal AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE ELSE (weight * words_left)::DOUBLE / open::DOUBLE END AS target,
         ('0x' || substr(md5('17|' || coalesce(source, chr(1))), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u FROM remaining),
ranked AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size::DOUBLE ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.key) AS rank
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
crossed AS (SELECT *, least(floor(u + rank * rate) - floor(u + (rank - 1) * rate), 3)::BIGINT AS copies FROM ranked)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM crossed
"""
