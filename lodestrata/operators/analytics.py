"""Totals, rankings and recent windows over a star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sum_total(df: DataFrame, measure: str, output: str) -> DataFrame:
    return df.agg(F.sum(measure).alias(output))


def top_n(df: DataFrame, by: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The n rows with the largest value; ``ties`` orders equal ones. Each task keeps n rows."""
    return df.orderBy(F.desc_nulls_last(by), *(F.asc(c) for c in ties)).limit(n)


def rank_top(df: DataFrame, by: str, n: int, output: str, ties: Sequence[str]) -> DataFrame:
    """The n rows with the largest value and their rank in the whole table.

    Equal to ranking everything and keeping n rows: the rank of a row depends only on rows above it,
    and all of those are among the n. So the ranking window sees n rows, not the table.
    """
    best_first = Window.orderBy(F.desc_nulls_last(by))
    return top_n(df, by, n, ties).withColumn(output, F.rank().over(best_first))


def count_per_class(
    links: DataFrame,
    classes: DataFrame,
    key: str,
    label: str,
    output: str,
    measure: str | None = None,
) -> DataFrame:
    """Links per class label (or the sum of ``measure``), largest first, equal ones by label.

    The links are summed up per key before the join, so a class that holds a large part of them
    joins as one row.
    """
    amount = F.count(F.lit(1)) if measure is None else F.sum(measure)
    per_key = links.groupBy(key).agg(amount.alias(output))
    total = F.sum(output).cast(per_key.schema[output].dataType)
    return (
        per_key.join(classes.select(key, label), key, "inner")
        .groupBy(label)
        .agg(total.alias(output))
        .orderBy(F.desc_nulls_last(output), F.asc(label))
    )


def latest_past_date(df: DataFrame, day: str, today: Column | None = None) -> DataFrame:
    """One row: the latest date that is not in the future."""
    limit = F.current_date() if today is None else today
    return df.filter(F.col(day) <= limit).agg(F.max(day).alias("latest"))


def in_last_months(day: Column | str, cutoff: Column, months: int) -> Column:
    """True for dates from ``months`` months before the cutoff up to the cutoff, both included."""
    value = F.col(day) if isinstance(day, str) else day
    return value.between(F.add_months(cutoff, -months), cutoff)
