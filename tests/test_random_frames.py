"""Marts and checks on random small frames against SQL of another engine."""

import duckdb
import pytest
from helpers import silver
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scorelake.operators import marts, quality
from scorelake.operators.games import games_by_console
from scorelake.seeds import console_mapping

IDS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
SCORES = st.one_of(st.none(), st.integers(76, 84))
NAMES = st.one_of(st.none(), st.sampled_from(["Wii", "GameCube", "PSP", "Xbox", "Dreamcast"]))
LISTS = st.one_of(st.none(), st.lists(NAMES, max_size=5))
ROWS = st.lists(st.tuples(IDS, SCORES, LISTS), max_size=12)

LISTED = """
WITH listed AS (
    SELECT id, score, mapping.* FROM games, UNNEST(consoles) AS u
    JOIN mapping ON u.unnest = mapping.console_name)
"""
COUNTS = """
    ROUND(AVG(score), 2), COUNT({0} id), COUNT({0} CASE WHEN score >= 80 THEN id END),
    ROUND(COUNT({0} CASE WHEN score >= 80 THEN id END) * 100.0 / NULLIF(COUNT({0} id), 0), 2)
"""


@pytest.fixture(scope="module")
def mapping(spark):
    return console_mapping(spark).cache()


def expected(rows, mapping_rows, query):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE games (id VARCHAR, score INT, consoles VARCHAR[])")
    connection.execute("CREATE TABLE mapping (console_name VARCHAR, brand VARCHAR, handheld BOOL)")
    connection.executemany("INSERT INTO mapping VALUES (?, ?, ?)", mapping_rows)
    if rows:
        connection.executemany("INSERT INTO games VALUES (?, ?, ?)", [list(row) for row in rows])
    return sorted(map(repr, connection.execute(query).fetchall()))


def actual(frame):
    return sorted(repr(tuple(row)) for row in frame.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_marts(spark, mapping, rows):
    table = games_by_console(silver(spark, rows), mapping)
    known = [tuple(row) for row in mapping.collect()]
    brands = LISTED + f"""SELECT brand, {COUNTS.format("")}
        FROM (SELECT DISTINCT id, score, brand FROM listed) GROUP BY brand"""
    assert actual(marts.brand_mart(table)) == expected(rows, known, brands)
    consoles = LISTED + f"""SELECT brand, console_name, handheld, {COUNTS.format("DISTINCT")}
        FROM listed GROUP BY brand, console_name, handheld"""
    assert actual(marts.console_mart(table)) == expected(rows, known, consoles)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_silver_checks(spark, mapping, rows):
    counts = quality.silver_checks(silver(spark, rows), mapping).select("check", "column", "failures")
    known = [tuple(row) for row in mapping.collect()]
    query = """
        SELECT 'not_null', 'game_id', COUNT(*) FROM games WHERE id IS NULL
        UNION ALL SELECT 'not_null', 'metacritic_score', COUNT(*) FROM games WHERE score IS NULL
        UNION ALL SELECT 'unique', 'game_id', COUNT(*) FROM
            (SELECT id FROM games WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1)
        UNION ALL SELECT 'coverage', 'console_name', COUNT(*) FROM mapping
            WHERE console_name NOT IN (SELECT u.unnest FROM games, UNNEST(consoles) AS u
                                       WHERE u.unnest IS NOT NULL)"""
    assert actual(counts) == expected(rows, known, query)
