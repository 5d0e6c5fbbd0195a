from casebook.functions.calendar import date_parts, daypart, time_parts
from casebook.functions.keys import surrogate_key
from casebook.functions.text import blank, column_or_null, path_token, path_token_text, present
from casebook.functions.typing import flag, outside, parse_timestamp, parse_timestamp_any, safe_cast, uncastable

__all__ = [
    "blank",
    "column_or_null",
    "date_parts",
    "daypart",
    "flag",
    "outside",
    "parse_timestamp",
    "parse_timestamp_any",
    "path_token",
    "path_token_text",
    "present",
    "safe_cast",
    "surrogate_key",
    "time_parts",
    "uncastable",
]
