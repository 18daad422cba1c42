"""Every registered query against its DuckDB equivalent on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from promptmill.plans.oracles import ORACLES
from promptmill.plans.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple(str(value) for value in row))


LARGER = Path("/root/testdata/sf0.01")


def connected(folder):
    connection = duckdb.connect()
    for file in folder.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module")
def duck():
    return connected(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_query(spark, duck, name):
    compare(spark, duck, name, SF_DIR)


@pytest.mark.skipif(not LARGER.exists(), reason="no test tables")
@pytest.mark.parametrize("partitions", ["1", "16"])
@pytest.mark.parametrize("name", ["accuracy_by_cycle", "accuracy_pivot", "compare_types", "cost_by_cycle"])
def test_means_on_more_rows(spark, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        compare(spark, connected(LARGER), name, LARGER)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def compare(spark, duck, name, folder):
    df = queries()[name](spark, str(folder))
    got = comparable(df.collect(), df.columns)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = comparable(cursor.fetchall(), columns)
    assert len(got) == len(want)
    for left, right in zip(got, want):
        for a, b in zip(left, right):
            same = a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12))
            assert same, (name, left, right)
