"""Star schema: dimensions, bridges, facts and the checks of their keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.keys import dense_key


@dataclass(frozen=True)
class Side:
    """A dimension as one end of a bridge.

    ``on`` pairs a column of the links with the column of the dimension it must equal.
    """

    table: DataFrame
    key: str
    on: Mapping[str, str]


def _equal(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> Column:
    """Equality of two columns; as text when their types differ, so no value can fail a cast."""
    a, b = left[left_column], right[right_column]
    if left.schema[left_column].dataType == right.schema[right_column].dataType:
        return a == b
    return a.cast("string") == b.cast("string")


def dimension(df: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """The distinct values of some columns with a dense key; ``columns`` maps source to output name."""
    values = df.select(*(F.col(c).alias(name) for c, name in columns.items())).distinct()
    return dense_key(values, list(columns.values()), key, stored=True)  # distinct rows leave a shuffle


def bridge(links: DataFrame, *sides: Side) -> DataFrame:
    """The distinct pairs of keys behind natural-key links; links without a partner drop out.

    Each join is followed by an exchange on other columns, so Spark may split a skewed partition of
    it at run time without breaking what comes after.
    """
    natural = list(dict.fromkeys(column for side in sides for column in side.on))
    joined = links.select(*natural)
    for side in sides:
        names = {column: f"_{side.key}_{i}" for i, column in enumerate(side.on.values())}
        partner = side.table.select(side.key, *(F.col(c).alias(n) for c, n in names.items()))
        matches = [_equal(joined, c, partner, names[d]) for c, d in side.on.items()]
        joined = joined.join(partner, reduce(and_, matches), "inner").drop(*names.values())
    return joined.select(*(side.key for side in sides)).distinct()


def fact(
    base: DataFrame,
    key: str,
    on: str,
    measures: Sequence[tuple[DataFrame, Mapping[str, str]]],
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """All rows of ``base`` with the measures other tables hold for them; none lost, absent is NULL.

    ``measures`` pairs each table with its columns and their types. A value that does not fit its
    type becomes NULL. All joins are on the same key, so each table is shuffled once. Each table has at
    most one row per key, so one that gives none of the ``wanted`` measures is not joined at all; Spark
    cannot know that and would keep the join.
    """
    rows = base.select(key, on)
    output = []
    for table, given in measures:
        types = {c: data_type for c, data_type in given.items() if wanted is None or c in wanted}
        if not types:
            continue
        right = table.select(F.col(on).alias("_on"), *types)
        rows = rows.join(right, _equal(rows, on, right, "_on"), "left").drop("_on")
        output += [F.col(c).try_cast(data_type).alias(c) for c, data_type in types.items()]
    return rows.select(key, *output)


def summary_dimension(
    details: DataFrame,
    dim: DataFrame,
    on: str,
    dim_key: str,
    key: str,
    summary: Mapping[str, Column],
) -> DataFrame:
    """Details summed up per natural key, for the keys the dimension knows, with a dense key.

    The summary runs before the join, so the join sees one row per natural key.
    """
    totals = details.groupBy(on).agg(*(c.alias(name) for name, c in summary.items()))
    known = dim.select(dim_key, F.col(on).alias("_on"))
    matched = totals.join(known, _equal(totals, on, known, "_on"), "inner").drop("_on")
    return dense_key(matched, [on], key).select(key, dim_key, *summary)


def orphans(links: DataFrame, dim: DataFrame, key: str, output: str = "orphans") -> DataFrame:
    """One row: how many links have a key the dimension lacks.

    Links are counted per key first: a key with many links joins as one row.
    """
    per_key = links.groupBy(key).agg(F.count(F.lit(1)).alias("_links"))
    strays = per_key.join(dim.select(key), key, "left_anti")
    return strays.agg(F.coalesce(F.sum("_links"), F.lit(0)).alias(output))


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: rows and keys of both sides, and the rows of each side the other one lacks.

    Both anti joins in one: the sides are counted per key and joined once. NULL keys match nothing.
    """
    a = left.groupBy(F.col(key).alias("_a")).agg(F.count(F.lit(1)).alias("_left"))
    b = right.groupBy(F.col(key).alias("_b")).agg(F.count(F.lit(1)).alias("_right"))
    both = a.join(b, F.col("_a") == F.col("_b"), "full")

    def rows(condition: Column, counted: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(counted))), F.lit(0))

    anywhere = F.lit(True)
    return both.agg(
        rows(anywhere, "_left").alias("left_rows"),
        F.count("_left").alias("left_keys"),
        rows(anywhere, "_right").alias("right_rows"),
        F.count("_right").alias("right_keys"),
        rows(F.col("_right").isNull(), "_left").alias("only_left"),
        rows(F.col("_left").isNull(), "_right").alias("only_right"),
    )
