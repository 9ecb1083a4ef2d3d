"""Number rules: parse only what is a number, and drop values that cannot be true."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions._cells import as_column, trimmed_text

# The texts accepted as numbers.
DECIMAL_TEXT = r"^-?\d+(\.\d+)?$"
INTEGER_TEXT = r"^-?\d+$"
COMMA_DECIMAL_TEXT = r"^-?\d+,\d+$"


def number_text(data_type: str) -> str:
    """The pattern a text must match to be read as ``data_type``."""
    return DECIMAL_TEXT if data_type == "double" else INTEGER_TEXT


def safe_number(c: Column | str, data_type: str = "double") -> Column:
    """The number a cell holds; NULL when the text is no number or does not fit the type."""
    text = trimmed_text(c)
    return F.when(text.rlike(number_text(data_type)), text.try_cast(data_type))


def is_not_number(c: Column | str, data_type: str = "double") -> Column:
    """True for a cell with text in it that is not a number; blank and NULL cells are False."""
    text = trimmed_text(c)
    return F.coalesce((text != "") & ~text.rlike(number_text(data_type)), F.lit(False))


def decimal_comma(c: Column | str) -> Column:
    """``154,34`` -> ``154.34`` when the whole cell is such a number; other text is only trimmed."""
    text = trimmed_text(c)
    return F.when(text.rlike(COMMA_DECIMAL_TEXT), F.translate(text, ",", ".")).otherwise(text)


def null_when(c: Column | str, distrusted: Column) -> Column:
    """The value, or NULL where ``distrusted`` is true."""
    return F.when(~F.coalesce(distrusted, F.lit(False)), as_column(c))


def null_outside(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """The value if ``low <= value <= high``, else NULL. A bound left out is not checked."""
    value = as_column(c)
    if low is not None and high is not None:
        return F.when(value.between(low, high), value)
    if low is not None:
        return F.when(value >= low, value)
    if high is not None:
        return F.when(value <= high, value)
    return value


def null_non_positive(c: Column | str) -> Column:
    """The value if it is above zero, else NULL."""
    value = as_column(c)
    return F.when(value > 0, value)
