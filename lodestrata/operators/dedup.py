"""One row per key, chosen by content and never by read order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of the SHA-256 of a row that are compared.
HASH_BYTES = 8


def keep_latest_and_most_complete(
    df: DataFrame,
    key: str | Sequence[str],
    order_column: str = "ingestion_datetime",
    completeness: Sequence[str] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The latest row of each key; on a tie the one with most cells filled, then a content order.

    The content order is the smallest SHA-256 of the joined cells, then the cells themselves: joining
    skips NULLs, so two different rows can share a hash. Only rows equal in all these cells tie.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a key
    that holds a large part of the table sends one row per map task. The hash is shuffled with each row, and no
    compression of a shuffle makes it shorter, so only its first ``HASH_BYTES`` bytes are: they sort like the whole
    hash, but for rows of one key that share them by chance, one pair in 2^64. ``derive`` adds
    cells that follow from those of their row. They count as the others do, but are computed again for the rows
    that are kept instead of being shuffled: rows equal in the other cells are equal in them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    whole = derive(df) if derive else df
    columns = list(completeness or [c for c in whole.columns if c not in (*keys, order_column)])
    filled = reduce(add, (F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    whole_hash = F.unhex(F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)), 256))
    fingerprint = F.substring(whole_hash, 1, HASH_BYTES)
    best_first = Window.partitionBy(*keys).orderBy(
        F.desc(order_column), F.desc("_filled"), F.asc("_hash"), *(F.asc(c) for c in columns if c in df.columns)
    )
    best = (
        whole.select(*df.columns, filled.alias("_filled"), fingerprint.alias("_hash"))
        .withColumn("_place", F.row_number().over(best_first))
        .filter(F.col("_place") == 1)
        .select(*df.columns)
    )
    return derive(best) if derive else best


def keep_latest_rows(df: DataFrame, key: str | Sequence[str], order_column: str = "ingestion_datetime") -> DataFrame:
    """All rows of each key that share its latest instant.

    Whatever ``keep_latest_and_most_complete`` chooses on all rows, it chooses on these: older ones never win. So
    they can be kept between runs and merged with new rows only. Rows of the latest instant of all, as those of a new
    batch, stay where they are; only the others are shuffled. The latest instant of each key is summed up per task and
    comes back by a join that Spark may split, so a key with a third of all rows is no task's burden. Whether all rows
    share one instant is asked while the frame is built; ``df`` is read several times, so it should be stored.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order, top = F.col(order_column), F.max(order_column)
    none_or_all = F.count(order_column).isin(F.lit(0), F.count(F.lit(1)))
    if df.agg((none_or_all & top.eqNullSafe(F.min(order_column))).alias("one")).first()["one"]:
        return df
    at_top = order.eqNullSafe(df.agg(top.alias("_top")).scalar())
    latest = df.groupBy(*keys).agg(top.alias("_latest"))
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    latest = latest.withColumnsRenamed(names)
    same = [F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()]
    newest = order.eqNullSafe(F.col("_latest"))
    older = df.filter(~at_top).join(latest, reduce(and_, [*same, newest]), "left_semi")
    return df.filter(at_top).unionByName(older)
