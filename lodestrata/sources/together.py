"""Independent steps side by side, and inputs of few files over all tasks."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")


def side_by_side(spark: SparkSession, *steps: Callable[[], Result], at_once: int | None = None) -> list[Result]:
    """The results of steps that do not need each other, in their order.

    Each step submits its Spark jobs from a thread of its own, so one step's last tasks leave no slots idle that
    another can use. All steps end before the first error, if any, is raised. What the steps shuffle lies on the
    disks together: no more than ``at_once`` of them run at a time, in their order.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(at_once or len(steps), len(steps)))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [future.result() for future in futures]


def spread(scan: DataFrame) -> DataFrame:
    """The rows of a plain scan over all tasks, if its files can be read by fewer.

    Files without row groups or blocks to split at, as compressed text or small tables, are read by one task each,
    and so would all rules on their rows be. A scan of at least as many parts as there are slots stays as it is.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= slots else scan.repartition(slots)
