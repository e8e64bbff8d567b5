"""Every query with a SQL equivalent gives the same rows in Spark and DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in values)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_same_rows(spark, duck, sf, name):
    frame = entry_module.queries()[name](spark, sf)
    relation = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert rows([tuple(r) for r in frame.collect()], frame.columns) == rows(relation.fetchall(), relation.columns)


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_runs(spark):
    assert "overall_anomaly_score" in entry_module.entry(spark).columns
