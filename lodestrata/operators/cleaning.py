"""Row rules: keep, drop and flag rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import is_name, is_not_number, null_when


def keep_members(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """The rows whose value is in a small fixed domain."""
    return df.filter(F.col(column).isin(*allowed))


def keep_names(df: DataFrame, column: str) -> DataFrame:
    """The rows whose text can be a name."""
    return df.filter(is_name(column))


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per combination of the columns; copies collapse before the shuffle."""
    return df.dropDuplicates(list(columns))


def flag_shifted_rows(df: DataFrame, number_types: Mapping[str, str], flag: str) -> DataFrame:
    """Mark the rows where a number column holds other text: their cells slipped sideways.

    Run it on the raw text, before any conversion.
    """
    strays = [is_not_number(column, data_type) for column, data_type in number_types.items()]
    return df.withColumn(flag, reduce(or_, strays))


def distrust_shifted_rows(df: DataFrame, columns: Iterable[str], flag: str) -> DataFrame:
    """NULL the named columns of flagged rows and drop the flag."""
    return df.withColumns({c: null_when(c, F.col(flag)) for c in columns}).drop(flag)
