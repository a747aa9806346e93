"""Every registered query against its DuckDB oracle on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        files = f"{SF_DIR}/{file}/*.parquet" if os.path.isdir(f"{SF_DIR}/{file}") else f"{SF_DIR}/{file}"
        connection.execute(
            f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{files}'")
    return connection


def in_order(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    answer = duck.execute(driver.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in answer.description}
    assert {name: SAME_TYPE[dtype] for name, dtype in df.dtypes} == types
    got = in_order(df.columns, [tuple(row) for row in df.collect()])
    assert got == in_order([column[0] for column in answer.description], answer.fetchall())
    assert got


def test_visit_kpi_has_no_exchange(spark):
    plan = driver.queries()["visit_kpi"](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_entry(spark):
    df = driver.entry(spark)
    assert len(df.columns) == 15 and df.count() > 0
