"""Projection-side operators: canonical schemas, audit and key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.columns import month_of, surrogate_key, year_of

# One spec entry: (accepted source names in priority order, target name, target type);
# type None keeps the source type (timestamps stay timestamp or timestamp_ntz).
Spec = Sequence[tuple[Sequence[str], str, str | None]]


def conform(df: DataFrame, spec: Spec, missing: str = "error", optional: Sequence[str] = ()) -> DataFrame:
    """Rename, cast and order columns to a canonical schema in one projection.

    For each target the first source name present in ``df`` wins (this is how
    physical typos such as ``schedualed_departure`` are accepted). A target
    with no source raises, unless it is named in ``optional`` or
    ``missing="null"`` makes all of them optional: those become typed NULLs.
    A target that keeps its source type is a time; text is cast to one.
    Catalyst collapses the result into one Project.
    """
    present = set(df.columns)
    cols = []
    for sources, target, dtype in spec:
        src = next((s for s in sources if s in present), None)
        if src is None:
            if missing == "error" and target not in optional:
                raise ValueError(f"conform: none of {list(sources)} present for {target!r}")
            cols.append(F.lit(None).cast(dtype or "timestamp").alias(target))
        else:
            c = F.col(src)
            if dtype is None and isinstance(df.schema[src].dataType, T.StringType):
                dtype = "timestamp"
            cols.append((c if dtype is None else c.cast(dtype)).alias(target))
    return df.select(*cols)


def with_audit(df: DataFrame, name: str = "ingestion_time") -> DataFrame:
    """Append the load timestamp column; a load time the rows already carry stays."""
    return df if name in df.columns else df.withColumn(name, F.current_timestamp())


def with_period(df: DataFrame, date_col: str, year: str = "year", month: str = "month") -> DataFrame:
    """Derive integer (year, month) reporting-period columns from a date/timestamp."""
    return df.withColumns({year: year_of(date_col), month: month_of(date_col)})


def with_surrogate_key(df: DataFrame, name: str, keys: Sequence[str], namespace: str | None = None,
                       mode: str = "hash") -> DataFrame:
    """Add an id column: deterministic hash of the natural key, or ``uuid()``.

    ``mode="uuid"`` reproduces random ids (built-in, no Python worker) for
    callers that need them; ``"hash"`` is the default because it is stable
    across reruns and so keeps foreign keys valid.
    """
    if mode == "uuid":
        return df.withColumn(name, F.expr("uuid()"))
    return df.withColumn(name, surrogate_key(namespace or name, *keys))
