"""Column expressions. Everything here is built from native Spark functions; there are no UDFs."""

from roadweave.functions.measures import (
    divide,
    exact_sum,
    from_limbs,
    km_to_mi,
    length_ratio_pct,
    limbs,
    per_capita,
    round_half_up,
)
from roadweave.functions.text import (
    blank_as_null,
    concat_present,
    corridor_number,
    milepost_to_double,
    milepost_to_number,
    reference_point,
    reference_point_to_number,
)

__all__ = [
    "blank_as_null",
    "concat_present",
    "corridor_number",
    "divide",
    "exact_sum",
    "from_limbs",
    "km_to_mi",
    "length_ratio_pct",
    "limbs",
    "milepost_to_double",
    "milepost_to_number",
    "per_capita",
    "reference_point",
    "reference_point_to_number",
    "round_half_up",
]
