"""Column expressions (JVM-side, inside whole-stage codegen; no Python UDFs)."""

from audix.functions.arrays import map_to_string, sorted_join
from audix.functions.calendar import iso_week_id, month_period_id
from audix.functions.hashing import hashed_id, unit_bucket
from audix.functions.money import exact_line_spend, spend_to_double
from audix.functions.probability import exponential_window_probability

__all__ = [
    "exact_line_spend", "exponential_window_probability", "hashed_id", "iso_week_id",
    "map_to_string", "month_period_id", "sorted_join", "spend_to_double", "unit_bucket",
]
