import pytest
from helpers import silver

from scorelake.operators import quality
from scorelake.operators.games import games_by_console
from scorelake.operators.marts import console_mart
from scorelake.seeds import BRANDS, CONSOLE_MAPPING, console_mapping

ALL_NAMES = [row[0] for row in CONSOLE_MAPPING]


def failures(summary):
    return {(row["check"], row["column"]): row["failures"] for row in summary.collect()}


def test_built_in_mapping_passes(spark):
    rows = quality.gate(quality.mapping_checks(console_mapping(spark), BRANDS))
    assert len(rows) == 4
    assert {row["status"] for row in rows} == {"pass"}


def test_mapping_failures(spark):
    rows = [("Wii", "Nintendo", False), ("Wii", "Sega", False), ("Saturn", "Sega", False)]
    rows += [(None, None, False), (None, "Atari", False)]
    mapping = spark.createDataFrame(rows, console_mapping(spark).schema)
    assert failures(quality.mapping_checks(mapping, BRANDS)) == {
        ("not_null", "console_name"): 2,
        ("unique", "console_name"): 1,
        ("not_null", "brand"): 1,
        ("accepted_values", "brand"): 2,
    }
    unexpected = quality.unexpected_values(mapping, "brand", BRANDS).collect()
    assert {tuple(row) for row in unexpected} == {("Sega", 2), ("Atari", 1)}


def test_silver_failures(spark):
    table = silver(
        spark,
        [
            ("a", 80, ALL_NAMES[:-1]),
            ("a", None, None),
            ("b", 70, ["Dreamcast", None]),
            (None, None, []),
            (None, 60, None),
        ],
    )
    summary = quality.silver_checks(table, console_mapping(spark))
    assert failures(summary) == {
        ("not_null", "game_id"): 2,
        ("unique", "game_id"): 1,
        ("not_null", "metacritic_score"): 2,
        ("coverage", "console_name"): 1,
    }
    assert quality.null_rows(table, "metacritic_score").count() == 2
    assert [tuple(row) for row in quality.repeated_values(table, "game_id").collect()] == [("a", 2)]
    unseen = quality.unseen_consoles(console_mapping(spark), table).collect()
    assert [row.console_name for row in unseen] == ["PlayStation 5"]
    mart = console_mart(games_by_console(table, console_mapping(spark)))
    in_mart = quality.unseen_in_mart(console_mapping(spark), mart).collect()
    assert [row.console_name for row in in_mart] == ["PlayStation 5"]


def test_an_empty_table_passes_key_checks(spark):
    summary = quality.key_checks(silver(spark, []), "silver_games", "game_id", ["metacritic_score"])
    assert set(failures(summary).values()) == {0}


def test_gate_names_what_failed(spark):
    summary = quality.key_checks(silver(spark, [("a", 1, []), ("a", 1, [])]), "silver_games", "game_id")
    with pytest.raises(quality.QualityGateError, match="unique silver_games.game_id: 1") as error:
        quality.gate(summary)
    assert [row["check"] for row in error.value.failed] == ["unique"]
