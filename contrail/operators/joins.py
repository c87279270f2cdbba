"""Join operators: period alignment, scalar attach, orphan detection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_periods(dfs: Sequence[DataFrame], keys: Sequence[str] = ("year", "month"),
                  how: str = "inner") -> DataFrame:
    """Join several period-grain tables on their shared keys (a fold of joins).

    Inputs are month-grain dimensions, so each side is tiny and AQE turns the
    joins into broadcast hash joins at run time from the measured sizes.
    """
    return reduce(lambda a, b: a.join(b, list(keys), how), dfs)


def attach_scalar(df: DataFrame, one_row: DataFrame, cols: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of one deterministic row of ``one_row`` to every row.

    Replaces ``limit(1).collect()`` + ``lit``: the pick is the smallest row
    by ``order`` (default ``cols``; rows whose first order column is NULL are
    skipped), computed as a global ``min`` over a struct — each task reduces
    its share to one row before the single final partition, so it is bounded
    — and attached as a scalar subquery, i.e. no join at all. Catalyst merges
    the per-column subqueries into one. An empty input gives NULLs.
    """
    order = list(order or cols)
    keyed = order + [c for c in cols if c not in order]
    pick = (one_row.where(F.col(order[0]).isNotNull())
            .select(F.min(F.struct(*keyed)).alias("__pick")))
    return df.withColumns({c: pick.select(F.col(f"__pick.{c}")).scalar() for c in cols})


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (a NULL key is an orphan).

    NULL keys are split off before the anti join: they can never match and
    would otherwise all hash to one reducer (one NULL-heavy key = one hot task).
    """
    pk = parent_key or child_key
    nulls = child.where(F.col(child_key).isNull())
    parents = parent.select(F.col(pk).alias("__pk")).where(F.col("__pk").isNotNull())
    keyed = child.where(F.col(child_key).isNotNull())
    missing = keyed.join(parents, keyed[child_key] == parents["__pk"], "left_anti")
    return missing.unionByName(nulls)


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """One row ``violations``: child rows whose key has no parent (NULL keys count).

    Join-free: child keys (weight 1) and parent keys (flag) are unioned and
    grouped by key. Partial aggregation map-side turns a key held by a third
    of all child rows into one row per task, and no key shape (constant,
    subquery-valued, NULL-heavy) can turn the check into a nested loop.
    """
    pk = parent_key or child_key
    kt = dict(child.dtypes)[child_key]
    c = child.select(F.col(child_key).alias("__k"), F.lit(1).cast("long").alias("__n"), F.lit(False).alias("__p"))
    p = parent.select(F.col(pk).cast(kt).alias("__k"), F.lit(0).cast("long").alias("__n"), F.lit(True).alias("__p"))
    by_key = c.unionByName(p).groupBy("__k").agg(F.sum("__n").alias("__n"), F.max("__p").alias("__p"))
    missing = F.col("__k").isNull() | ~F.col("__p")
    return by_key.agg(F.coalesce(F.sum(F.when(missing, F.col("__n"))), F.lit(0)).cast("bigint").alias("violations"))
