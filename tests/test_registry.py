import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_oracle import duck, rows_of
from registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
# Long runs, covered in smaller form by other tests.
SLOW = [n for n in QUERIES if n.startswith("recipe_") or n in ("m04_network", "m05_perceptron")]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    out = entry_points.entry(spark)
    assert out.count() > 0 and "rate" in out.columns


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n not in SLOW])
def test_other_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_tables_are_there():
    assert len(glob.glob(os.path.join(SF, "*.parquet"))) == 14 and duckdb.__version__


@pytest.mark.parametrize("name", [n for n in SLOW if n not in ORACLES])
def test_long_runs_give_rows(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
