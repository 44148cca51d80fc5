"""What the plans read, broadcast and shuffle."""

import re

import pytest

from scorelake import order_feed as feed
from scorelake.operators import games, marts, quality
from scorelake.seeds import console_mapping
from scorelake.sources import pages, tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bronze_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "bronze")
    tables.write_months(feed.games(spark, FOLDER), path, compact=True)
    return path


@pytest.fixture(scope="module")
def silver_path(spark, bronze_path, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "silver")
    tables.write_months(games.to_silver(tables.read_bronze(spark, bronze_path)), path)
    return path


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def formatted(frame):
    execution = frame._jdf.queryExecution()
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return execution.explainString(mode)


def read_schemas(frame):
    return re.findall(r"ReadSchema: (.*)", formatted(frame))


def exchanges(frame):
    return len(re.findall(r"^[\s:+|-]*Exchange ", plan(frame), re.MULTILINE))


def test_nested_columns_are_pruned(spark, bronze_path):
    silver = games.to_silver(tables.read_bronze(spark, bronze_path))
    assert read_schemas(silver.select("console_names")) == [
        "struct<game:struct<platforms:array<struct<platform:struct<name:string>>>>>"
    ]
    (wide,) = read_schemas(silver)
    assert "slug" not in wide and "downloaded_at" not in wide


def test_months_prune_folders(spark, bronze_path):
    one = tables.read_bronze(spark, bronze_path).filter("date = '1996-06'")
    assert "PartitionFilters: [isnotnull(date" in formatted(one)
    assert "(date" in formatted(one)


def test_slice_reaches_the_scan(spark, silver_path):
    text = formatted(games.source_slice(tables.read_silver(spark, silver_path), "1996-01", "1996-12"))
    (pushed,) = re.findall(r"PushedFilters: (.*)", text)
    assert "GreaterThanOrEqual(metacritic_score,1)" in pushed
    assert "GreaterThanOrEqual(release_date,1996-01-01)" in pushed
    (folders,) = re.findall(r"PartitionFilters: (.*)", text)
    assert "1996-01" in folders and "1996-12" in folders


def test_silver_needs_no_shuffle(spark, bronze_path):
    assert exchanges(games.to_silver(tables.read_bronze(spark, bronze_path))) == 0


def test_marts_read_little_and_shuffle_games_once(spark, silver_path):
    table = games.games_by_console(tables.read_silver(spark, silver_path), console_mapping(spark))
    assert exchanges(table) == 0 and "BroadcastHashJoin" in plan(table)
    for mart, spread in (
        (marts.brand_mart(table), ["game_id", "metacritic_score", "brand"]),
        (marts.console_mart(table), ["brand", "console_name", "is_handheld", "game_id"]),
    ):
        keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(mart))
        assert [re.sub(r"#\d+", "", key).split(", ") for key in keys][-1] == spread
        assert exchanges(mart) == 2
        assert "Expand" not in plan(mart) and "SortMergeJoin" not in plan(mart)
        # Both aggregations combine inside the task before they shuffle.
        assert plan(mart).count("HashAggregate(") == 4
        (schema,) = read_schemas(mart)
        assert "game_name" not in schema and "genre_names" not in schema


def test_silver_checks_scan_twice(spark, silver_path):
    silver = tables.read_silver(spark, silver_path)
    schemas = read_schemas(quality.silver_checks(silver, console_mapping(spark)))
    assert schemas == [
        "struct<metacritic_score:int,game_id:string>",
        "struct<console_names:array<string>>",
    ]


def test_raw_months_prune_folders(spark, tmp_path):
    raw = str(tmp_path / "raw")
    pages.write_pages(pages.paginate(feed.games(spark, FOLDER)), raw)
    one = pages.read_pages(spark, raw, ["1996-06"])
    # Other months' folders are not even listed.
    assert {path.rsplit("/", 2)[1] for path in one.inputFiles()} == {"date=1996-06"}
    (location,) = re.findall(r"Location: (.*)", formatted(one))
    assert "date=1996-06" in location and "1 paths" not in location.replace("(1 paths)", "")
