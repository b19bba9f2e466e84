from quarry.functions.arith import pct_change, ratio
from quarry.functions.labels import (WEEKDAYS_MONDAY_FIRST, Bin, bin_by, clean_label, map_values,
                                     order_by_list, two_way)
from quarry.functions.predicates import (after, before, ci_eq, ci_like, drop_period, in_period,
                                         not_blank, not_flagged)
from quarry.functions.timeparts import (day_bit, month_abbrev, shift_hours, ts_literal,
                                        weekday_name, weekday_number, whole_units_between)

__all__ = [
    "ratio", "pct_change",
    "Bin", "bin_by", "map_values", "two_way", "clean_label", "order_by_list",
    "WEEKDAYS_MONDAY_FIRST",
    "ci_eq", "ci_like", "not_flagged", "not_blank", "in_period", "drop_period", "after", "before",
    "ts_literal", "whole_units_between", "weekday_name", "weekday_number", "shift_hours",
    "day_bit", "month_abbrev",
]
