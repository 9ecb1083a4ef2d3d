"""Delimited cells to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import split_list, strip_edges


def explode_list(df: DataFrame, key: str, column: str, element: str) -> DataFrame:
    """One row per element of a delimited cell; a NULL cell gives no rows."""
    return df.select(key, F.explode(F.transform(split_list(column), F.trim)).alias(element))


def explode_entities(
    df: DataFrame, key: str, kind_of_column: Mapping[str, str], name: str, kind: str, once: bool = False
) -> DataFrame:
    """Several delimited columns as one tall table (key, name, kind), in one scan of the input.

    Names are stripped before they become rows, so a filter that comes after uses finished ones. ``once`` keeps a
    name that a cell repeats as one row, before any row is made.
    """
    cells = [
        F.struct(F.lit(label).alias(kind), F.col(column).alias("_cell"))
        for column, label in kind_of_column.items()
    ]
    tall = df.select(key, F.inline(F.array(*cells)))
    names = F.transform(split_list("_cell"), strip_edges)
    return tall.select(key, F.explode(F.array_distinct(names) if once else names).alias(name), kind)
