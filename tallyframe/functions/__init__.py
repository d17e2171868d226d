"""Column-level helpers (each returns a ``Column``)."""

from tallyframe.functions.text import (
    counted_label,
    id_list,
    is_present,
    number_in_text,
    optional_part,
    words,
)
from tallyframe.functions.calendar import (
    as_date,
    day_of_week_sun1,
    days_between,
    month_start,
    week_of_year_sun0,
    whole_minutes,
)

__all__ = [
    "counted_label", "id_list", "is_present", "number_in_text", "optional_part", "words",
    "as_date", "day_of_week_sun1", "days_between", "month_start", "week_of_year_sun0",
    "whole_minutes",
]
