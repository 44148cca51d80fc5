import duckdb
import pytest

from scorelake.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    rows = sorted(str(tuple(row)) for row in found.select(*columns).collect())
    with duckdb.connect() as sql:
        for table in ("documents", "embeddings", "pages", "benchmark"):
            sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        asked = sql.execute(ORACLE[name])
        names = [column[0] for column in asked.description]
        expected = [dict(zip(names, row, strict=True)) for row in asked.fetchall()]
    assert sorted(names) == columns and rows
    assert rows == sorted(str(tuple(row[name] for name in columns)) for row in expected)
