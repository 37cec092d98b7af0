"""Queries that SQL can express, against DuckDB on the same files."""

import os

import duckdb
import pytest

from tidefeed.llm import queries as q


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, name):
    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        view, extension = os.path.splitext(file)
        if extension == ".parquet":
            duck.execute(f"CREATE VIEW {view} AS FROM '{sf_dir}/{file}'")
    answer = duck.execute(q.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    got = q.queries()[name](spark, sf_dir).select(*names)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, answer.fetchall()))


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in q.queries()} == {f"op{i}" for i in range(1, 14)}
