"""Scalar Column expressions shared by the builders.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen and never crosses into a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start, end) -> Column:
    """Signed minutes from ``start`` to ``end`` as double (early = negative).

    The interval is cast to whole seconds, the same truncation toward zero as
    ``CAST(end - start AS long) / 60``; works for timestamp and timestamp_ntz
    without depending on the session time zone.
    """
    return ((_c(end) - _c(start)).cast("long") / F.lit(60.0)).cast("double")


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def year_of(c) -> Column:
    return F.year(_c(c)).cast("int")


def month_of(c) -> Column:
    return F.month(_c(c)).cast("int")


def surrogate_key(namespace: str, *keys) -> Column:
    """Deterministic id: sha-256 hex of ``namespace|k1|k2…``.

    Replaces a per-row Python uuid UDF: it is reproducible across reruns (so
    foreign keys between tables stay valid), needs no Python worker and keeps
    the plan inside codegen. ``concat_ws`` skips NULL keys.
    """
    parts = [F.lit(namespace)] + [_c(k).cast("string") for k in keys]
    return F.sha2(F.concat_ws("|", *parts), 256)
