"""Every registered query against DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from logvigil.plans.oracle import ORACLE_SQL as ORACLE
from logvigil.plans.queries import QUERIES

SCALES = ["sf0.001", "sf0.01"]


@pytest.fixture(scope="module")
def oracles(data_root):
    connections = {}
    for scale in SCALES:
        connection = duckdb.connect()
        for file in Path(data_root, scale).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        connections[scale] = connection
    return connections


def _sorted(rows, order):
    rows = [tuple(row[position] for position in order) for row in rows]
    return sorted(rows, key=lambda row: tuple((value is not None, str(value)) for value in row))


def _equal(left, right):
    return left == right and type(left) is type(right)


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, data_root, oracles, name, scale):
    result = QUERIES[name](spark, str(Path(data_root, scale)))
    answer = oracles[scale].execute(ORACLE[name])
    expected_columns = [column[0] for column in answer.description]
    expected = answer.fetchall()
    assert sorted(result.columns) == sorted(expected_columns)
    names = sorted(expected_columns)
    got = _sorted(result.collect(), [result.columns.index(column) for column in names])
    want = _sorted(expected, [expected_columns.index(column) for column in names])
    assert len(got) == len(want)
    for got_row, want_row in zip(got, want, strict=True):
        assert all(map(_equal, got_row, want_row)), (got_row, want_row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
