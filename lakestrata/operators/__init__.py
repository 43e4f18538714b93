from lakestrata.operators.harmonise import SourceMap, harmonise, keep_null, map_source
from lakestrata.operators.quality import (
    COVID_GATE, COVID_RULES, PASS, Rule, annotate, gate, ratio, ratio_check, report,
)
from lakestrata.operators.reconcile import (
    has_pending, load_missing, missing_keys, pending, pending_count, with_target,
)
from lakestrata.operators.series import (
    cumulative_to_daily, hot_keys, lag_value, previous_values,
)
from lakestrata.operators.star import (
    calendar_dim, fact, first_per_key, location_dim, with_location_key,
)

__all__ = [
    "COVID_GATE", "COVID_RULES", "PASS", "Rule", "SourceMap", "annotate",
    "calendar_dim", "cumulative_to_daily", "fact", "first_per_key", "gate",
    "harmonise", "has_pending", "hot_keys", "keep_null", "lag_value", "load_missing",
    "location_dim", "map_source", "missing_keys", "pending", "pending_count",
    "previous_values", "ratio", "ratio_check", "report", "with_location_key",
    "with_target",
]
