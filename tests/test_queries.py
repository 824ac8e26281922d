"""Every registered query next to its SQL, on the smallest tables, with generated code."""

import os

import pytest
from check_oracle import compare, connect, run_sql

import __spark_entry__ as entry
from workloads import base

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")


@pytest.fixture(scope="module")
def compiled(spark):
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query_equals_sql(compiled, database, name):
    sql = base.SQL[name]
    df = entry.queries()[name](compiled, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    assert rows, "a query that returns nothing shows nothing"
    assert compare(df.columns, rows, *run_sql(database, sql)) == ""


def test_every_query_has_sql():
    assert set(base.QUERIES) == set(base.SQL)


def test_entry_runs(compiled):
    assert entry.entry(compiled).columns == ["vec_id", "dataset", "score", "matched"]
