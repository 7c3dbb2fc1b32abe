from tradeflow.functions.columns import (
    exact_integer,
    exact_long,
    pad_code,
    period,
    sentence_case,
    squish,
    strict_sum,
    strict_sums,
)

__all__ = [
    "exact_integer",
    "exact_long",
    "pad_code",
    "period",
    "sentence_case",
    "squish",
    "strict_sum",
    "strict_sums",
]
