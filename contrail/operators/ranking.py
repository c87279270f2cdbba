"""Top-k and dedupe operators built on partitioned windows.

Windows are always partitioned (never a single global partition) and a
``row_number() <= k`` filter lets Catalyst insert ``WindowGroupLimit``, which
trims each group map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group by ``order``.

    ``order`` must end with enough columns to make the order total; callers
    append the label as an ascending tie-break so results are deterministic.
    """
    if not keys:
        raise ValueError("top_n_per_group needs partition keys (a global window runs in one task)")
    rn = rank_col or "__rn"
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def most_frequent(df: DataFrame, keys: Sequence[str], label: str, out: str | None = None,
                  count_col: str | None = None, weight: str | None = None) -> DataFrame:
    """Per group of ``keys``, the ``label`` value with the most rows.

    Counting happens first (partial aggregation map-side, so a hot key costs
    one row per task, not one row per record); the window then ranks at most
    (#groups × #labels) rows. NULL labels are ignored; ties go to the
    alphabetically smallest label. ``weight`` names a pre-aggregated row
    count to sum instead of counting rows.
    """
    cnt = count_col or "__cnt"
    measure = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (df.where(F.col(label).isNotNull())
              .groupBy(*keys, label).agg(measure.alias(cnt)))
    top = top_n_per_group(counts, keys, [F.col(cnt).desc(), F.col(label).asc()], 1)
    top = top.withColumnRenamed(label, out or label)
    return top if count_col else top.drop(cnt)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """Deterministic dedupe: keep one row per key, the first by ``order``.

    Default order: latest ``ingestion_time`` first, then every other column,
    so equal duplicates collapse and the survivor never depends on task order.
    """
    if order is None:
        rest = [c for c in df.columns if c not in keys]
        order = ([F.col("ingestion_time").desc_nulls_last()] if "ingestion_time" in rest else []) + \
                [F.col(c).asc_nulls_last() for c in rest if c != "ingestion_time"]
    return top_n_per_group(df, keys, order, 1)


def most_frequent_many(df: DataFrame, keys: Sequence[str], labels: dict[str, str],
                       weight: str | None = None) -> DataFrame:
    """``most_frequent`` for several label columns at once, in one pass.

    One ``GROUPING SETS ((keys, l1), (keys, l2), …)`` aggregate counts every
    label (so ``df`` is read once, however many labels are ranked), a window
    over (keys, label kind) picks each winner — most rows, ties to the
    alphabetically smallest, NULL labels ignored — and a final group-by puts
    the winners side by side. A group appears only when every label has a
    winner (the inner-join semantics of ranking each label separately).
    """
    cols = list(labels)
    measure = F.sum(weight) if weight else F.count(F.lit(1))
    g = df.groupingSets([[*keys, c] for c in cols], *keys, *cols).agg(
        measure.alias("__n"), *[F.grouping(c).alias(f"__g{i}") for i, c in enumerate(cols)])
    kind = F.coalesce(*[F.when(F.col(f"__g{i}") == 0, F.lit(i)) for i in range(len(cols))])
    value = F.coalesce(*[F.when(F.col(f"__g{i}") == 0, F.col(c).cast("string")) for i, c in enumerate(cols)])
    g = g.withColumns({"__kind": kind, "__v": value}).where(F.col("__v").isNotNull())
    top = top_n_per_group(g, [*keys, "__kind"], [F.col("__n").desc(), F.col("__v").asc()], 1)
    out = top.groupBy(*keys).agg(*[F.max(F.when(F.col("__kind") == i, F.col(c))).alias(labels[c])
                                   for i, c in enumerate(cols)])
    return out.where(reduce(lambda a, b: a & b, [F.col(o).isNotNull() for o in labels.values()]))
