"""Money rules: strict parse of amounts, currency conversion, profit and margin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions._cells import as_column, trimmed_text

# An amount is an optional currency mark, digits (plain or in comma groups) and an
# optional scale letter.
MONEY_TEXT = (
    r"^(?:US\$|USD|R\$|\$|€)?\s*"
    r"(\d{1,16}(?:\.\d{1,6})?|\d{1,3}(?:,\d{3}){1,4}(?:\.\d{1,6})?)\s*([KMB])?$"
)
SCALE_OF_LETTER = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000}

MONEY_TYPE = "decimal(18,2)"


def money(c: Column | str) -> Column:
    """The amount as decimal(18,2); NULL for anything that is not exactly one amount, or too large.

    The currency mark is ignored, not converted. All six decimals take part in the scaling, so
    ``1.234567M`` is 1234567.00. A text that does not match has no digits. A text that ends in a digit
    has no letter, so most cells meet the pattern once. Missing digits are NULL before the cast: a
    failed decimal cast costs many times a good one.
    """
    text = F.upper(trimmed_text(c))
    digits = F.nullif(F.regexp_extract(text, MONEY_TEXT, 1), F.lit(""))
    plain = F.lit(1).cast("decimal(10,0)")
    letter = F.regexp_extract(text, MONEY_TEXT, 2)
    scales = F.create_map(*(F.lit(x) for pair in SCALE_OF_LETTER.items() for x in pair))
    scale = F.when(F.substring(text, -1, 1).between("0", "9"), plain).otherwise(
        F.coalesce(scales[letter].cast("decimal(10,0)"), plain)
    )
    amount = F.translate(digits, ",", "").try_cast("decimal(22,6)") * scale
    return amount.try_cast(MONEY_TYPE)


def convert_currency(c: Column | str, rate: Column | float) -> Column:
    """The amount times the rate, rounded to cents (double)."""
    factor = rate if isinstance(rate, Column) else F.lit(float(rate))
    return F.round(as_column(c) * factor, 2)


def profit(revenue: Column | str, cost: Column | str) -> Column:
    return as_column(revenue) - as_column(cost)


def margin_percent(revenue: Column | str, cost: Column | str) -> Column:
    """Profit in percent of cost; NULL when a side is missing or the cost is zero."""
    share = F.try_divide(profit(revenue, cost), as_column(cost))
    return F.round(F.try_multiply(share, F.lit(100)), 2)
