"""Every registered query with SQL agrees with it on the smallest tables; the others run."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from tests.helpers import table

DATA = "/root/testdata/sf0.001"
CORE = [m for m in __spark_entry__.MODULES if ".llm" not in m.__name__]
NAMES = [n for m in CORE for n in m.QUERIES]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    found = __spark_entry__.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    got = table(found.collect(), found.columns, columns)
    sql = __spark_entry__.oracle_sql().get(name)
    if sql:
        wanted = duck.execute(sql)
        names = [d[0] for d in wanted.description]
        assert sorted(names) == columns
        assert got == table(wanted.fetchall(), names, columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
