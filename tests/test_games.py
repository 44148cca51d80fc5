import pytest
from helpers import AT, bronze, game, silver
from pyspark.sql import functions as F

from scorelake.operators import games, joins
from scorelake.schemas import GAME, SILVER
from scorelake.seeds import CONSOLE_MAPPING, console_mapping


def test_unnest_repeats_page_columns_and_drops_empty_pages(spark):
    rows = [(AT, [game(1), game(2)], "2022-02"), (AT, [], "2022-03"), (AT, None, "2022-04")]
    schema = f"downloaded_at timestamp, results array<{GAME.simpleString()}>, date string"
    unnested = games.unnest_results(spark.createDataFrame(rows, schema))
    found = unnested.select("game.id", "date", F.unix_micros("downloaded_at").alias("at"))
    assert {tuple(row) for row in found.collect()} == {
        (1, "2022-02", 1767323045678901),
        (2, "2022-02", 1767323045678901),
    }


def test_silver_row(spark):
    row = game(
        5,
        81,
        ["Wii", None, "PSP"],
        name="Pokémon — Edizione Blu",
        genres=[],
        esrb_rating=None,
    )
    typed = games.to_silver(bronze(spark, [row]))
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in SILVER]
    found = typed.first()
    assert found.game_name == "Pokémon — Edizione Blu"
    assert (found.game_id, found.metacritic_score) == ("5", 81)
    assert str(found.release_date) == "2022-02-03"
    assert found.console_names == ["Wii", None, "PSP"]
    assert found.genre_names == []
    assert found.esrb_rating is None


def test_silver_keeps_null_lists_and_scores(spark):
    found = games.to_silver(bronze(spark, [game(1, None, None, released=None)])).first()
    assert found.console_names is None
    assert found.metacritic_score is None
    assert found.release_date is None


@pytest.mark.parametrize("ansi", [True, False])
@pytest.mark.parametrize(
    "released", ["2022-02", "2022", "soon", "2022-13-01", "2022/02/30", "", "2022-02/03", "20220203", "2022-02-03 x"]
)
def test_bad_release_raises(spark, released, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a date with year|DATETIME_FIELD_OUT_OF_BOUNDS"):
            games.to_silver(bronze(spark, [game(released=released)])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "released",
    ["2022-02-03", "2022-2-3", "2022/02/03", "2022\\02\\03", "2022 02 03", " 2022-02-03\t", "02022-02-03"]
    + ["2022-02-03 10:11:12", "2022-02-03T10:11", "2022-02-03 10:11:12+02"],
)
def test_releases_that_name_a_day(spark, released):
    found = games.to_silver(bronze(spark, [game(released=released)])).first()
    assert str(found.release_date) == "2022-02-03"


def test_score_too_large_raises(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        games.to_silver(bronze(spark, [game(score=3_000_000_000)])).collect()


def test_fractional_scores_round(spark):
    whole = bronze(spark, [game(1, 81)])
    fractional = whole.withColumn(
        "game", F.col("game").withField("metacritic", F.lit(81.5).cast("double"))
    )
    found = games.to_silver(fractional)
    assert dict(found.dtypes)["metacritic_score"] == "int"
    assert found.first().metacritic_score == 82


def test_source_slice(spark):
    rows = [
        game(1, 0, released="2022-02-01"),
        game(2, 1, released="2022-02-28"),
        game(3, 100, released="2022-02-01"),
        game(4, 101, released="2022-02-01"),
        game(5, None, released="2022-02-01"),
        game(6, 50, released="2022-03-01"),
        game(7, 50, released="2022-01-31"),
    ]
    found = games.source_slice(games.to_silver(bronze(spark, rows)), "2022-02", "2022-02")
    assert [row.game_id for row in found.collect()] == ["3", "2"]


@pytest.mark.parametrize("hot", [False, True])
def test_slices_are_sorted_over_several_tasks(spark, monkeypatch, hot):
    """Dealt out by days, or by a range sort where one day is too much for a task."""
    monkeypatch.setattr(games, "LEAST_ROWS", 10)
    day = "if(id % 3 > 0, 5, id * 7 % 90)" if hot else "id * 7 % 90"
    rows = spark.range(600).selectExpr(
        f"date_format(date_add(date'2022-01-01', int({day})), 'yyyy-MM') AS date",
        f"date_add(date'2022-01-01', int({day})) AS release_date",
        "string(id % 250) AS game_id",
        "int(1 + id % 99) AS metacritic_score",
    )
    found = games.source_slice(rows, "2022-01", "2022-03")
    keys = [(row.release_date, row.game_id) for row in found.collect()]
    assert len(keys) == 600 and keys == sorted(keys)
    if not hot:
        assert found.select(F.spark_partition_id().alias("task")).distinct().count() > 1
    assert ("rangepartitioning" in _plan(found)) == hot
    assert games.source_slice(rows.filter("false"), "2022-01", "2022-03").count() == 0


def test_unnest_consoles(spark):
    listed = games.unnest_consoles(
        silver(spark, [("a", 1, ["Wii", None, "Wii"]), ("b", 1, []), ("c", 1, None)]), "game_id"
    )
    found = [tuple(row) for row in listed.collect()]
    assert found == [("a", "Wii"), ("a", None), ("a", "Wii")]


def test_games_by_console_keeps_repeats_and_drops_unknown(spark):
    table = silver(spark, [("a", 80, ["Wii", "Wii", "Dreamcast", None, "PSP"]), (None, None, ["Wii"])])
    found = games.games_by_console(table, console_mapping(spark))
    assert found.columns == ["game_id", "metacritic_score", "console_name", "brand", "is_handheld"]
    assert sorted(map(str, (tuple(row) for row in found.collect()))) == sorted(
        map(
            str,
            [
                ("a", 80, "Wii", "Nintendo", False),
                ("a", 80, "Wii", "Nintendo", False),
                ("a", 80, "PSP", "Sony", True),
                (None, None, "Wii", "Nintendo", False),
            ],
        )
    )


def test_built_in_mapping(spark):
    mapping = console_mapping(spark)
    assert [tuple(row) for row in mapping.collect()] == CONSOLE_MAPPING
    counts = {row.brand: row["count"] for row in mapping.groupBy("brand").count().collect()}
    assert counts == {"Microsoft": 4, "Nintendo": 9, "Sony": 7}
    assert mapping.filter("is_handheld").count() == 6


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_large_dimension_is_joined_by_shuffle_with_the_same_rows(spark):
    names = [row[0] for row in CONSOLE_MAPPING]
    # A third of all listings are of one console.
    rows = [(str(n), n % 100, ["Wii", names[n % 20], names[n * 7 % 20]]) for n in range(3000)]
    listed = games.unnest_consoles(silver(spark, rows), "game_id")
    mapping = console_mapping(spark)
    small = joins.join_dimension(listed, mapping, "console_name", "game_id")
    assert "BroadcastHashJoin" in _plan(small)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = joins.join_dimension(listed, mapping, "console_name", "game_id", broadcast_bytes=0)
        assert "SortMergeJoin" in _plan(large)
        assert large.columns == small.columns
        assert large.exceptAll(small).count() == 0
        assert small.exceptAll(large).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
