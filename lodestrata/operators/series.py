"""Daily series: one value per day, no day missing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _day(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def _days(first: Column, last: Column) -> Column:
    """All days of the closed range; no days when it is empty or open."""
    return F.explode(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))))


def calendar(spark: SparkSession, start: date | str, end: date | str, day: str = "day") -> DataFrame:
    """One row per day of the closed range; an end before the start gives no rows."""
    return spark.range(1).select(_days(_day(start), _day(end)).alias(day))


def calendar_between(one_row: DataFrame, first: str, last: str, day: str = "day") -> DataFrame:
    """One row per day between two days that a one-row frame holds, without fetching them."""
    return one_row.select(_days(F.col(first), F.col(last)).alias(day))


def latest_per_day(
    df: DataFrame, instant: str, value: str, day: str, output: str, by: Sequence[str] = ()
) -> DataFrame:
    """The last value of each day; equal instants take the larger value.

    Readings without a value, or with a text that is no instant, are left out first: neither hides
    another reading. A plain max per group: each map task sends one row per day, however many readings
    a day has.
    """
    moment = F.col(instant).try_cast("timestamp")
    newest = F.max(F.struct(moment.alias("at"), F.col(value).alias("value")))
    return (
        df.filter(moment.isNotNull() & F.col(value).isNotNull())
        .groupBy(*by, moment.cast("date").alias(day))
        .agg(newest.alias("_newest"))
        .select(*by, day, F.col("_newest.value").alias(output))
    )


def fill_forward(
    df: DataFrame,
    day: str,
    value: str,
    start: date | str,
    end: date | str,
    by: Sequence[str] = (),
    from_first_value: bool = False,
) -> DataFrame:
    """A row for every day of the range; a day without a value takes the last one before it.

    ``df`` has one row per day (and series, when ``by`` names the columns that tell them apart).
    ``from_first_value`` starts earlier where the first stored day lies before ``start``. The start
    stays inside the plan. A series is ordered in one task, which sees at most one row per calendar
    day; different series are filled in parallel.
    """
    first = _day(start)
    if from_first_value:
        first = F.least(first, F.min(day))
    last = _day(end)
    ranges = df.groupBy(*by).agg(first.alias("_first")) if by or from_first_value else None
    if ranges is None:
        days = calendar(df.sparkSession, start, end, day)
    else:
        days = ranges.select(*by, _days(F.col("_first"), last).alias(day))
    in_order = (
        Window.partitionBy(*by)
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = F.last(value, ignorenulls=True).over(in_order)
    return days.join(df, [*by, day], "left").select(*by, day, carried.alias(value))


def latest_value(df: DataFrame, day: str, value: str, output: str = "latest") -> DataFrame:
    """One row: the value of the latest day that has one (NULL when none has)."""
    known = df.filter(F.col(value).isNotNull())
    return known.agg(F.max_by(value, F.struct(day, value)).alias(output))


def require_value(one_row: DataFrame, message: str) -> Column:
    """The single value of a one-row frame for use in other plans; NULL stops the job with ``message``."""
    value = one_row.scalar()
    data_type = one_row.schema.fields[0].dataType
    return F.coalesce(value, F.raise_error(F.lit(message)).cast(data_type))
