from scorelake.functions.display import count_label, display_rank, known_category, value_lookup
from scorelake.functions.months import (
    month_bounds,
    month_calendar,
    month_key,
    months_between,
    strict_date,
)
from scorelake.functions.numbers import percentage, round2, to_int

__all__ = [
    "count_label",
    "display_rank",
    "known_category",
    "month_bounds",
    "month_calendar",
    "month_key",
    "months_between",
    "percentage",
    "round2",
    "strict_date",
    "to_int",
    "value_lookup",
]
