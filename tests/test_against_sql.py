"""Every registered query against the same question asked in SQL of another engine."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from scorelake.oracle import ORACLE
from scorelake.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted(FOLDER.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def _value(value):
    if isinstance(value, float) and math.isfinite(value):
        return repr(value)
    return "" if value is None else str(value)


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda index: names[index])
    return sorted(tuple(_value(row[index]) for index in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, tables, name):
    result = QUERIES[name](spark, str(FOLDER))
    cursor = tables.execute(ORACLE[name])
    expected_types = {column[0]: TYPE_NAMES[str(column[1])] for column in cursor.description}
    expected = _sorted_rows(cursor.fetchall(), list(expected_types))
    assert dict(result.dtypes) == expected_types
    actual = _sorted_rows(result.collect(), result.columns)
    assert len(actual) == len(expected)
    assert actual == expected
    assert expected, "a comparison of nothing proves nothing"


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 4
