import os
import sys
import tempfile
import time
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lodestrata.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ["TZ"] = "UTC"
    time.tzset()
    scratch = tempfile.mkdtemp(prefix="lodestrata-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lodestrata-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
