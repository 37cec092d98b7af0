"""Every registered query against DuckDB on the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES = contract.feed_queries()
ORACLES = contract.feed_oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir_module):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir_module)):
        view, extension = os.path.splitext(file)
        if extension == ".parquet":
            connection.execute(f"CREATE VIEW {view} AS FROM '{sf_dir_module}/{file}'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def sf_dir_module():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def comparable(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir_module, name):
    result = QUERIES[name](spark, sf_dir_module)
    answer = duck.execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(names)
    got = comparable(result.collect(), result.columns)
    expected = comparable(answer.fetchall(), names)
    assert len(got) == len(expected)
    assert got == expected


def test_entry_gives_rows(spark):
    result = contract.entry(spark)
    assert result.columns == list(contract.ENVELOPE)
    assert result.count() > 0
