"""Session settings the plans are written for. All can be changed while a session runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan by measured sizes, and split skewed join partitions even where that costs a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wide cleaning rules generate long methods. HotSpot does not compile methods over 8000 bytes;
    # below that Spark generates several short ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A map task sorts or sums up all it reads before it sends anything, so what it reads is bounded, however
    # large the files are: rows of a few megabytes grow to some hundred in memory, and none are spilled.
    "spark.sql.files.maxPartitionBytes": "4m",
    # The same for what a task reads from a shuffle: partitions are merged up to this size only.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
