"""Column -> Column rules. Bad data becomes NULL; no rule raises on a row."""

from lodestrata.functions.dates import multi_date
from lodestrata.functions.money import convert_currency, margin_percent, money, profit
from lodestrata.functions.numbers import (
    decimal_comma,
    is_not_number,
    null_non_positive,
    null_outside,
    null_when,
    safe_number,
)
from lodestrata.functions.text import (
    default_blank,
    is_blank,
    is_name,
    map_values,
    normalize_label,
    split_list,
    strip_edges,
    title_case_words,
)

__all__ = [
    "convert_currency",
    "decimal_comma",
    "default_blank",
    "is_blank",
    "is_name",
    "is_not_number",
    "map_values",
    "margin_percent",
    "money",
    "multi_date",
    "normalize_label",
    "null_non_positive",
    "null_outside",
    "null_when",
    "profit",
    "safe_number",
    "split_list",
    "strip_edges",
    "title_case_words",
]
