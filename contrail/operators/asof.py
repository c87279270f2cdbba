"""As-of join: for each row the last row of another table that began on or before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import materialize


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, match: str = "match") -> DataFrame:
    """Every row of ``left`` with the struct ``match``: the row of ``right`` with equal ``by`` columns and the greatest ``right_at <= left_at``.

    ``match`` is NULL where there is none, and for rows with a NULL key or time. ``right`` must hold one row per key and time.

    Both tables become one, range-partitioned and sorted by key and time, and the last right row is carried
    forward: no product of rows, whatever a key's size. A hot key simply spans several ranges (a hash in the
    sort key spreads even rows of one key and time); what a range ends with is handed to the next ones
    through a table of two rows per partition.
    """
    spark, n = left.sparkSession, len(by)
    keys = [f"__k{i}" for i in range(n)]
    shape = right.select(F.struct(*[F.col(c) for c in right.columns]).alias("r")).schema["r"].dataType
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, left_at]])
    began = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, right_at]])
    row = F.struct(*[F.col(c) for c in left.columns])
    a = left.where(whole).select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(left_at).alias("__at"), F.lit(1).alias("__kind"),
                                 F.pmod(F.xxhash64(row), F.lit(1024)).alias("__salt"), row.alias("__left"), F.lit(None).cast(shape).alias("__right"))
    b = right.where(began).select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(right_at).alias("__at"), F.lit(0).alias("__kind"),
                                  F.lit(0).cast("long").alias("__salt"), F.lit(None).cast(a.schema["__left"].dataType).alias("__left"),
                                  F.struct(*[F.col(c) for c in right.columns]).alias("__right"))
    both = a.unionByName(b).repartitionByRange(*keys, "__at", "__kind", "__salt").withColumn("__part", F.spark_partition_id())
    both = materialize(spark, both, "asof")  # the ranges are sampled: all uses must see the same ones
    upto = Window.partitionBy("__part", *keys).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = both.withColumn("__held", F.last("__right", ignorenulls=True).over(upto)).where("__kind = 1")
    # first and last key of every partition; the right row that the last key ends with
    key = F.struct(*keys)
    ends = both.groupBy("__part").agg(F.min(key).alias("lowest"), F.max(key).alias("highest"))
    last = (both.where("__kind = 0").withColumn("__key", key)
            .join(F.broadcast(ends.select(F.col("__part").alias("__p"), "highest")), (F.col("__part") == F.col("__p")) & (F.col("__key") == F.col("highest")))
            .groupBy(F.col("__part").alias("part"), F.col("__key").alias("key")).agg(F.max_by("__right", "__at").alias("__carry"))
            .withColumn("turn", F.lit(1)))
    first = ends.select(F.col("__part").alias("part"), F.col("lowest").alias("key"), F.lit(None).cast(shape).alias("__carry"), F.lit(0).alias("turn"))
    before = Window.partitionBy("key").orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    carry = (first.unionByName(last).withColumn("__carry", F.last("__carry", ignorenulls=True).over(before)).where("turn = 0 and __carry is not null")
             .select(F.col("part").alias("__to"), F.col("key").alias("__of"), "__carry"))
    # at most one row per partition: broadcast
    found = here.join(F.broadcast(carry), (F.col("__part") == F.col("__to")) & (key == F.col("__of")), "left")
    out = found.select("__left.*", F.coalesce("__held", "__carry").alias(match))
    return out.unionByName(left.where(~whole).withColumn(match, F.lit(None).cast(shape)))
