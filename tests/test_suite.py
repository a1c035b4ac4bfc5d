"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        assert len(got) > 0
    else:
        assert compare(got, sql.execute(oracle).df()) == ""


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith(("stream_", "src_"))))
def test_streaming_query_again(spark, sql, name):
    """What one run of a stream leaves in the process does not disturb the next one."""
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert compare(got, sql.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
