from quarry.operators.aggs import (attr, cents, daily_rate, days_in,
                                  per_month,
                                  period_daily_rates, pivot_sums, representative, scaled_ratio,
                                  spread,
                                  with_total)
from quarry.operators.joins import (anti, anti_by_outer_join, broadcast_if_small, dedupe_join,
                                   estimated_bytes, fanout, join_back_top,
                                   per_key, semi)
from quarry.operators.profile import (all_null_columns, blank_null_breakdown, duplicate_keys,
                                      orphan_keys, profile_table)
from quarry.operators.ranking import best_in_group, count_best, page, top_k

__all__ = [
    "attr", "cents", "daily_rate", "days_in", "per_month", "period_daily_rates",
    "pivot_sums", "representative", "scaled_ratio", "spread", "with_total",
    "anti", "anti_by_outer_join", "broadcast_if_small", "dedupe_join", "estimated_bytes",
    "fanout", "join_back_top", "per_key", "semi",
    "all_null_columns", "blank_null_breakdown", "duplicate_keys", "orphan_keys", "profile_table",
    "best_in_group", "count_best", "page", "top_k",
]
