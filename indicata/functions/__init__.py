from .scalars import (
    CAST_MODES,
    cast_coerce,
    cast_ignore,
    cast_strict,
    completeness,
    days_to_timestamp,
    finite_or_null,
    key_text,
    nan_to_null,
    ratio_fill_zero,
    ratio_plain,
    round_scaled,
    text_to_timestamp,
)

__all__ = [
    "CAST_MODES",
    "cast_coerce",
    "cast_ignore",
    "cast_strict",
    "completeness",
    "days_to_timestamp",
    "finite_or_null",
    "key_text",
    "nan_to_null",
    "ratio_fill_zero",
    "ratio_plain",
    "round_scaled",
    "text_to_timestamp",
]
