"""Every query against its SQL on the smallest tables, and plan checks."""

import os
import subprocess
import sys

import pytest
from oracle import compare, connect

from __spark_entry__ import entry
from roadlog.showcase import QUERIES, SQL


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(SQL))
def test_same_as_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, SQL[name], allow_empty=True) is None


def test_byte_chunks_are_whole(spark, small):
    got = QUERIES["bulk_byte_chunks"](spark, small).collect()
    assert sum(r.n for r in got) == spark.read.parquet(f"{small}/events.parquet").count()
    assert all(r.bytes <= 8192 and r.n <= 500 for r in got)


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(__file__)))


def test_entry(spark):
    assert entry(spark).count() > 0
