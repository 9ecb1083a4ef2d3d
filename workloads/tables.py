"""The driver tables and the inputs derived from them, as DataFrames."""

from __future__ import annotations

import warnings
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from lodestrata.session import tune
from lodestrata.sources import spread
from workloads.inputs import INPUTS

_ZONE = "spark.sql.session.timeZone"


class Tables:
    """Driver tables of one folder: ``t["orders"]`` reads a table, ``t.input("money_txt")`` derives one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = tune(spark)
        if spark.conf.get(_ZONE) != "UTC":
            warnings.warn(f"{_ZONE} of this session becomes UTC: the driver tables hold UTC instants", stacklevel=2)
            spark.conf.set(_ZONE, "UTC")
        self._folder = folder.rstrip("/")

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{table}.parquet")

    def input(self, name: str) -> DataFrame:
        text = INPUTS[name]
        used = {field for _, field, _, _ in Formatter().parse(text) if field}
        return self.spark.sql(text, **{table: spread(self[table]) for table in used})
