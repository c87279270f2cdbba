"""Column-level helpers (all built-in expressions; no Python UDFs)."""

from contrail.functions.columns import (  # noqa: F401
    minutes_between,
    month_of,
    safe_ratio,
    surrogate_key,
    year_of,
)
