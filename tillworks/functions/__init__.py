"""Column functions shared by the operators."""

from tillworks.functions.columns import (
    cents,
    clean,
    code,
    date_key,
    line_total,
    money,
    packed_key,
    padded_day_name,
    padded_month_name,
    parse_instant,
    serving_money,
    surrogate_key,
    title,
    unpacked_key,
    whole_number,
    with_computed,
)

__all__ = [
    "cents",
    "clean",
    "code",
    "date_key",
    "line_total",
    "money",
    "packed_key",
    "padded_day_name",
    "padded_month_name",
    "parse_instant",
    "serving_money",
    "surrogate_key",
    "title",
    "unpacked_key",
    "whole_number",
    "with_computed",
]
