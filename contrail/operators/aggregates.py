"""Declarative grouped aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FN = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, object]]) -> DataFrame:
    """``{out: (fn, column-or-expr)}`` per group; no keys → one global row.

    ``count`` with ``"*"`` counts rows; with a column it counts non-NULLs.
    All functions are algebraic, so Spark aggregates partially before the
    shuffle (a hot key costs one buffer per task).
    """
    exprs = []
    for out, (fn, c) in aggs.items():
        col = F.lit(1) if c == "*" else (F.col(c) if isinstance(c, str) else c)
        exprs.append(_FN[fn](col).alias(out))
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)
