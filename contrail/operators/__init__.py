"""DataFrame → DataFrame operators (projection, ranking, joins, aggregation)."""

from contrail.operators.shaping import conform, with_audit, with_period, with_surrogate_key  # noqa: F401
from contrail.operators.ranking import latest_per_key, most_frequent, most_frequent_many, top_n_per_group  # noqa: F401
from contrail.operators.asof import asof_join  # noqa: F401
from contrail.operators.joins import align_periods, attach_scalar, orphan_count, orphans  # noqa: F401
from contrail.operators.aggregates import group_stats  # noqa: F401
