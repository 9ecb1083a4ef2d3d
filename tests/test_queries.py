"""Every registered query against its SQL, and the shape of every plan, on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from compare import compare
from workloads.inputs import TABLES
from workloads.oracles import ORACLES
from workloads.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_without_cross_join_or_python(spark, connection, name):
    frames = []

    def query(session, folder):
        frames.append(QUERIES[name](session, folder))
        return frames[0]

    assert compare(spark, connection, FOLDER, name, query, ORACLES[name])
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop|EvalPython|InPandas|PythonUDF", plan)


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 10
