"""Table operators: DataFrame in, DataFrame out."""

from roadweave.operators.joins import (
    MatchClasses,
    RoundedKey,
    interval_join,
    interval_sides,
    lookup_ends,
    match_classes,
    not_in_present,
    rounded_join,
)
from roadweave.operators.ordering import (
    next_value,
    numbered,
    place_of_groups,
    preview,
    rank_quantiles,
    running_count_at_key,
    top_per_group,
    upper_fence_filter,
    value_codes,
)
from roadweave.operators.quality import (
    assert_key,
    blank_to_null,
    conflicting_keys,
    keep_unambiguous,
    keep_unique,
    key_violations,
)
from roadweave.operators.shaping import (
    conform,
    minus,
    reverse_ends,
    sanitize_columns,
    select_star,
    stack,
)

__all__ = [
    "MatchClasses",
    "RoundedKey",
    "assert_key",
    "blank_to_null",
    "conflicting_keys",
    "conform",
    "interval_join",
    "interval_sides",
    "keep_unambiguous",
    "keep_unique",
    "key_violations",
    "lookup_ends",
    "match_classes",
    "minus",
    "next_value",
    "not_in_present",
    "numbered",
    "place_of_groups",
    "preview",
    "rank_quantiles",
    "reverse_ends",
    "rounded_join",
    "running_count_at_key",
    "sanitize_columns",
    "select_star",
    "stack",
    "top_per_group",
    "upper_fence_filter",
    "value_codes",
]
