"""Intermediate tables in the shared folder of the cluster.

A staged table cuts the lineage: later steps read files every executor can reach, so a lost executor
costs the rerun of its tasks and never of the steps before.

Every application has one folder of its own. ``staged_run`` drops what was staged inside it, also
after an error; ``drop_staged`` drops everything the application has staged, and so does the end of the
program that staged it.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

_SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
_DROP_SHUFFLES_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
_runs: list[str] = []
_dropped_at_exit: set[str] = set()


def staging_folder(spark: SparkSession) -> str:
    """The folder of this application's staged tables.

    It lies in the cluster's checkpoint folder, or, where none is set, in the warehouse: both are
    places every executor reaches, whatever the master is.
    """
    shared = spark.conf.get(_SHARED_FOLDER_SETTING, None) or spark.conf.get(_WAREHOUSE_SETTING)
    return f"{shared.rstrip('/')}/lodestrata/{spark.sparkContext.applicationId}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of its own in the staging folder and read it back."""
    spark = df.sparkSession
    _drop_at_exit(spark)
    path = "/".join([_runs[-1] if _runs else staging_folder(spark), uuid.uuid4().hex])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_into(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside lie in a folder of their own, which stays: see ``drop_folder``. A folder that is opened
    inside another one lies in it, and goes with it."""
    folder = f"{_runs[-1] if _runs else staging_folder(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside are dropped at the end, also after an error."""
    with staging_into(spark) as folder:
        try:
            yield folder
        finally:
            drop_folder(spark, folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write or query shuffles inside is deleted as soon as it ends.

    Otherwise it stays on the disks of the executors until the driver happens to collect its garbage, so that the
    shuffles of a long run add up. For steps that read each frame once: a second action on a frame that was
    collected inside would shuffle again. Steps side by side must all lie inside, as the setting is the session's.
    """
    before = spark.conf.get(_DROP_SHUFFLES_SETTING, None)
    spark.conf.set(_DROP_SHUFFLES_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES_SETTING)
        else:
            spark.conf.set(_DROP_SHUFFLES_SETTING, before)


def drop_staged(spark: SparkSession) -> None:
    """Drop all tables this application has staged; frames over them can no longer be read."""
    drop_folder(spark, staging_folder(spark))


def _drop_at_exit(spark: SparkSession) -> None:
    folder = staging_folder(spark)
    if folder not in _dropped_at_exit:
        _dropped_at_exit.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        atexit.register(_drop_quietly, system, path)


def _drop_quietly(system, path) -> None:
    with suppress(Exception):  # the engine may be gone by then
        system.delete(path, True)


def drop_unread(frame: DataFrame, folder: str) -> None:
    """Of the tables staged into a folder, drop those that ``frame`` does not read."""
    spark = frame.sparkSession
    read = {file.rsplit("/", 1)[0].rsplit("/", 1)[1] for file in frame.inputFiles()}
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(path) if system.exists(path) else ():
        if status.getPath().getName() not in read:
            system.delete(status.getPath(), True)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of staged tables, wherever the cluster keeps it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
