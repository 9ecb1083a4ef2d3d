"""Layer databases and table writes.

Writes survive a run that fails: a replaced table keeps its old rows until the new ones are all written, and a
batch that is written again takes the place of what it wrote before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from lodestrata.sources.landing import read_landing_csv, stamp_ingestion
from lodestrata.sources.staging import drop_folder

# The layers of the store.
LAYERS = ("bronze", "silver", "gold")
#: Formats whose tables are plain folders of files. Others replace a table by means of their own.
FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv")
#: How the files of new tables are compressed, where a format leaves the choice: a third smaller than by Spark's own.
COMPRESSION = {"parquet": "zstd"}
#: The column that tells the batches of a table apart, and that its folders are named by.
BATCH = "ingestion_batch"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure_layers(spark: SparkSession, layers: Iterable[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.format(fmt)
    return writer.option("compression", COMPRESSION[fmt]) if fmt in COMPRESSION else writer


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    _writer(df, fmt).mode("append").saveAsTable(table)


# --- batches --------------------------------------------------------------------------------------


def batch_name(moment: datetime) -> str:
    """The batch of a run: its instant in UTC, so that names sort by time. An instant without a zone is UTC."""
    zoned = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    return zoned.astimezone(UTC).strftime("%Y%m%dT%H%M%S%fZ")


def append_batch(df: DataFrame, table: str, batch: str, fmt: str = "parquet") -> int:
    """Add a batch of rows, or put it in place of what an earlier try wrote; returns its rows.

    Each batch is a partition of its own. A try that fails leaves the partition as it was; one that brings no
    rows empties it. Other batches are not touched. Columns other than the table's stop the job.
    """
    spark = df.sparkSession
    rows = df.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(table):
        # The table comes first and empty, so a failed write leaves no half-made one behind.
        _writer(rows.limit(0), fmt).partitionBy(BATCH).mode("ignore").saveAsTable(table)
    columns = spark.table(table).columns
    if set(columns) != set(rows.columns):
        odd = sorted(set(columns) ^ set(rows.columns))
        raise ValueError(f"{table}: the batch and the table differ in columns {odd}")
    seen = Observation()
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows")).select(*columns)
    with _own_partitions_only(spark):
        observed.write.insertInto(table, overwrite=True)
    written = seen.get["rows"]
    if not written:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH} = '{batch}')")
    return written


@contextmanager
def _own_partitions_only(spark: SparkSession) -> Iterator[None]:
    """Overwrites inside replace the partitions they write, once all is written, and no others."""
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def batches_of(spark: SparkSession, table: str) -> list[str]:
    """The batches a table holds, oldest first: one name per run, from the catalogue alone."""
    names = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(row["partition"].split("=", 1)[1] for row in names)


# --- replaced tables ------------------------------------------------------------------------------


def _database_and_name(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.replace("`", "").rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def _versions(spark: SparkSession, table: str) -> str:
    """The folder that holds the versions of a replaced table."""
    database, name = _database_and_name(spark, table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}.versions"


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Location", "Provider", "Type")}


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet", keep_before: bool = True) -> None:
    """Put ``df`` in place of a table, which may be one that ``df`` reads.

    The rows are written to a folder of their own; only then the table is pointed to it, by one change in the
    catalogue. A write that fails leaves the old rows. The version before stays until the next overwrite, for
    readers that have begun; older ones, and what failed writes left, are deleted then. One writer per table. Without
    ``keep_before`` the version before is deleted at once, as for a table that only its writer reads.
    A table with other columns or another format is made anew: its old self is renamed until the new one stands.
    """
    spark = df.sparkSession
    if fmt not in FILE_FORMATS:
        df.write.format(fmt).mode("overwrite").saveAsTable(table)
        return
    versions = _versions(spark, table)
    version = f"{versions}/{uuid.uuid4().hex}"
    _writer(df, fmt).save(version)
    aside = f"{table}__before"
    facts = _facts(spark, table) if spark.catalog.tableExists(table) else None
    if facts and facts["Type"] == "EXTERNAL" and facts["Provider"] == fmt and spark.table(table).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        if facts:
            spark.sql(f"DROP TABLE IF EXISTS {aside}")
            spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        spark.catalog.createTable(table, path=version, source=fmt, schema=df.schema)
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
    spark.catalog.refreshTable(table)
    kept = {version, facts["Location"] if facts and keep_before else version}
    _drop_versions(spark, versions, {folder.rstrip("/").rsplit("/", 1)[1] for folder in kept})


def _drop_versions(spark: SparkSession, versions: str, kept: set[str]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(versions)
    for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
        if status.getPath().getName() not in kept:
            drop_folder(spark, status.getPath().toString())


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    versions = _versions(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    drop_folder(spark, versions)


# --- ingestion ------------------------------------------------------------------------------------


def ingest_files(
    spark: SparkSession,
    folder: str,
    table_of_file: Mapping[str, str],
    moment: datetime | None = None,
    fmt: str = "parquet",
    reader: Callable[[SparkSession, str], DataFrame] = read_landing_csv,
    batch: str | None = None,
) -> dict[str, int]:
    """Append every landed file to its table, stamped; returns the rows written per table.

    The counts are observed while the rows are written, so no file is read a second time. With ``batch`` the
    rows are that batch of their tables, and ingesting it again after a failure changes nothing.
    """
    written = {}
    for file_name, table in table_of_file.items():
        rows = stamp_ingestion(reader(spark, f"{folder}/{file_name}"), moment)
        if batch is not None:
            written[table] = append_batch(rows, table, batch, fmt)
            continue
        seen = Observation()
        append_table(rows.observe(seen, F.count(F.lit(1)).alias("rows")), table, fmt)
        written[table] = seen.get["rows"]
    return written
