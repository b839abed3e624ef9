"""Column expressions shared by the operators (all built-in, JVM-side)."""

from starloom.functions.dates import date_key, padded_name, month_start, whole_months_between
from starloom.functions.inet import is_inet
from starloom.functions.json import payload_field, payload_text, json_timestamp_text
from starloom.functions.numeric import pct, round_ratio

__all__ = [
    "date_key",
    "padded_name",
    "month_start",
    "whole_months_between",
    "is_inet",
    "payload_field",
    "payload_text",
    "json_timestamp_text",
    "pct",
    "round_ratio",
]
