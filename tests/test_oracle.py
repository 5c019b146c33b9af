"""Every query against its DuckDB statement, as the driver compares them."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from foralytics.oracle import ORACLE
from foralytics.queries import QUERIES, TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result_as_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(
        expected.columns, expected.fetchall()
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["QuestionId", "NRespuestas", "ScoreTotal"]
    assert df.count() > 0
