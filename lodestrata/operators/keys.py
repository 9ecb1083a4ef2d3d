"""Dense surrogate keys 1..N without sending the table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.staging import stage

# monotonically_increasing_id() holds the partition number above this bit, the row number below.
_ROW_BITS = 33


def dense_key(df: DataFrame, order_by: Sequence[str], key: str, stored: bool = False) -> DataFrame:
    """The rows with ``key`` = 1..N in the order of ``order_by``, NULLs first.

    Equal to a row_number() over the whole table, but that would sort everything in one task. Here
    the table is sorted over all tasks (range partitions), each row gets its partition and its place
    in it, and the result is staged once so that both are fixed. The key is the place plus the rows
    of the partitions before: one number per partition, as many rows as there are partitions, which
    is what is broadcast.

    ``order_by`` should identify a row; equal rows get different keys in any order. The sort reads its rows twice,
    once to sample the range partitions. So ``df`` is staged first and computed once, unless it is ``stored``: a
    table that was just written, or rows that leave a shuffle, which Spark keeps. Staged tables are written
    while the frame is built.
    """
    rows = df if stored else stage(df)
    number = F.monotonically_increasing_id()
    numbered = (
        rows.orderBy(*(F.col(c).asc_nulls_first() for c in order_by))
        .withColumn("_number", number)
        .select(
            *df.columns,
            F.shiftright("_number", _ROW_BITS).cast("int").alias("_part"),
            (F.col("_number").bitwiseAND((1 << _ROW_BITS) - 1) + 1).alias("_place"),
        )
    )
    staged = stage(numbered)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_part")
        .agg(F.max("_place").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return staged.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_place")).cast("bigint").alias(key), *df.columns
    )
