"""Column expressions and header rules; everything here stays in the JVM."""

from tallymart.functions.cells import (
    fold_na_tokens,
    null_text_to_null,
    parse_datetime,
    round2,
    round_measures,
    std_null,
    value_or_null,
    yes_no,
)
from tallymart.functions.dates import AmbiguousDates, UnreadableDates, detect_orders, parse_detected
from tallymart.functions.export_text import (
    as_export_text,
    datetime_resolutions,
    export_name,
    publish_path,
)
from tallymart.functions.headers import rename_headers, snake_case

__all__ = [
    "AmbiguousDates",
    "UnreadableDates",
    "as_export_text",
    "datetime_resolutions",
    "detect_orders",
    "export_name",
    "fold_na_tokens",
    "null_text_to_null",
    "parse_datetime",
    "parse_detected",
    "publish_path",
    "rename_headers",
    "round2",
    "round_measures",
    "snake_case",
    "std_null",
    "value_or_null",
    "yes_no",
]
