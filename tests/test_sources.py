import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import AT, bronze, game, land
from pyspark.sql import functions as F

from scorelake import order_feed as feed
from scorelake.operators.games import to_silver, unnest_results
from scorelake.schemas import BRONZE, SILVER
from scorelake.seeds import CONSOLE_MAPPING, console_mapping
from scorelake.sources import pages, storage, tables
from scorelake.sources.layout import Layout

FOLDER = "/root/testdata/sf0.01"


def ids(table):
    return sorted((row.date, row.id) for row in table.select("date", "game.id").collect())


def landed_ids(spark, raw, **options):
    return ids(unnest_results(pages.read_pages(spark, str(raw), **options)))


# Pages


def test_indented_pages(spark, tmp_path):
    land(tmp_path, "2022-02", [game(1, name="Pokémon — Edizione Blu")], [game(2), game(3)])
    land(tmp_path, "2022-03", [game(4)])
    read = pages.read_pages(spark, str(tmp_path))
    assert read.count() == 3
    found = unnest_results(read).filter("game.id = 1").select(
        "game.name", "date", F.unix_micros("downloaded_at").alias("at")
    )
    assert tuple(found.first()) == ("Pokémon — Edizione Blu", "2022-02", 1767323045678901)


def test_months_prune_and_may_be_missing(spark, tmp_path):
    land(tmp_path, "2022-02", [game(1)])
    land(tmp_path, "2022-03", [game(2)])
    assert landed_ids(spark, tmp_path, months=["2022-03", "2022-04"]) == [("2022-03", 2)]
    assert landed_ids(spark, tmp_path, months=["2022-04"]) == []


def test_fields_outside_the_schema_stay_in_the_document(spark, tmp_path):
    land(tmp_path, "2022-02", [game(1) | {"stores": [{"store": {"name": "x"}}], "tba": False}])
    read = unnest_results(pages.read_pages(spark, str(tmp_path)))
    assert read.select("game.*").columns == BRONZE["game"].dataType.names
    (row,) = read.collect()
    document = json.loads(row.document)
    assert document["stores"] == [{"store": {"name": "x"}}] and document["tba"] is False


def test_page_that_does_not_fit_raises(spark, tmp_path):
    land(tmp_path, "2022-02", [game(1)])
    land(tmp_path, "2022-03", [game(2, score="high")])
    (tmp_path / "date=2022-04").mkdir()
    (tmp_path / "date=2022-04" / "page_1.json").write_text('{"results": [')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landed_ids(spark, tmp_path)
    marked = pages.marked_pages(spark, str(tmp_path)).select("date", "bad").collect()
    assert {row.date: row.bad for row in marked} == {"2022-02": False, "2022-03": True, "2022-04": True}


@pytest.mark.parametrize("body", ['{"detail": "no such page"}', '{"results": null}', "7", '{"results": 3}'])
def test_a_page_without_results_is_malformed(spark, tmp_path, body):
    land(tmp_path, "2022-02", [])
    land(tmp_path, "2022-03", [game(1)])
    (tmp_path / "date=2022-03" / "page_2.json").write_text(body)
    marked = pages.marked_pages(spark, str(tmp_path)).select("date", "bad").collect()
    assert sorted((row.date, row.bad) for row in marked) == [
        ("2022-02", False),
        ("2022-03", False),
        ("2022-03", True),
    ]


def test_pages_are_read_in_the_form_they_were_written_in(spark, tmp_path):
    raw = str(tmp_path)
    games = feed.games(spark, "/root/testdata/sf0.001")
    half = games.filter("date < '1998-01'")
    pages.write_pages(pages.paginate(half, AT), raw, pages.ONE_PER_FILE)
    pages.write_pages(pages.paginate(games.exceptAll(half), AT), raw)
    assert landed_ids(spark, raw) == ids(games)
    for form, month in ((pages.ONE_PER_FILE, "1999-01"), (pages.ONE_PER_LINE, "1996-01")):
        with pytest.raises(pages.PageFormError, match=month):
            landed_ids(spark, raw, months=[month], form=form)


def test_fractional_scores_are_read(spark, tmp_path):
    land(tmp_path, "2022-02", [game(1, 81.5), game(2, 80.0), game(3, 7)])
    silver = to_silver(unnest_results(pages.read_pages(spark, str(tmp_path))))
    assert {row.game_id: row.metacritic_score for row in silver.collect()} == {"1": 82, "2": 80, "3": 7}


def test_a_poor_first_month_does_not_spoil_the_next(spark, tmp_path):
    """Empty lists and null ratings say nothing about the types of later months."""
    raw, table = tmp_path / "raw", str(tmp_path / "bronze")
    land(raw, "2022-02", [game(1, None, [], genres=[], esrb_rating=None)])
    land(raw, "2022-03", [game(2, 80, ["Wii"])])
    for month in ("2022-02", "2022-03"):
        read = pages.read_pages(spark, str(raw), [month])
        tables.replace_months(spark, unnest_results(read), table, [month])
    found = {row.game_id: row for row in to_silver(tables.read_bronze(spark, table)).collect()}
    assert (found["2"].console_names, found["2"].esrb_rating) == (["Wii"], "Teen")
    assert (found["1"].console_names, found["1"].esrb_rating) == ([], None)


def test_written_pages(spark, tmp_path):
    table = bronze(spark, [game(1, None, name="Pokémon", esrb_rating=None), game(2)])
    packed = pages.paginate(table.coalesce(1), AT)
    pages.write_pages(packed, str(tmp_path), pages.ONE_PER_FILE)
    (file,) = tmp_path.glob("date=2022-02/*.json")
    text = file.read_text(encoding="utf-8")
    assert "Pokémon" in text and "\n  " in text
    page = json.loads(text)
    assert page["downloaded_at"] == AT.isoformat()
    assert [one["id"] for one in page["results"]] == [1, 2]
    assert page["results"][0]["metacritic"] is None
    assert page["results"][0]["esrb_rating"] is None
    assert landed_ids(spark, tmp_path) == [("2022-02", 1), ("2022-02", 2)]


def test_stamp_is_the_time_of_the_run_unless_given(spark):
    stamped = pages.paginate(bronze(spark, [game(1)]))
    assert stamped.select(F.expr("downloaded_at BETWEEN now() - INTERVAL 1 HOUR AND now()")).first()[0]


@pytest.mark.parametrize("form", [pages.ONE_PER_FILE, pages.ONE_PER_LINE])
def test_pages_hold_forty_games_at_most_and_every_game(spark, tmp_path, form):
    """Even when a single month holds a third of all games."""
    games = feed.games(spark, FOLDER).withColumn(
        "date", F.when(F.col("game.id") % 3 == 0, F.lit("1996-06")).otherwise(F.col("date"))
    )
    packed = pages.paginate(games.repartition(5), AT)
    pages.write_pages(packed, str(tmp_path), form=form)
    read = pages.read_pages(spark, str(tmp_path), form=form)
    sizes = [row.n for row in read.select(F.size("results").alias("n")).collect()]
    assert max(sizes) == 40
    # Only the end of a partition or of its part of a month cuts a page short.
    assert len(sizes) <= sum(sizes) / 40 + 5 * (81 + 1)
    assert landed_ids(spark, tmp_path, form=form) == ids(games)


def test_pages_are_ordered_by_release(spark):
    rows = [game(1, released="2022-02-09"), game(2, released="2022-02-01"), game(3, released="2022-02-09")]
    page = pages.paginate(bronze(spark, rows).coalesce(1), AT).first()
    assert [one.id for one in page.results] == [2, 1, 3]


def test_pages_written_again_replace_their_month(spark, tmp_path):
    pages.write_pages(pages.paginate(bronze(spark, [game(1), game(2)]), AT), str(tmp_path))
    pages.write_pages(pages.paginate(bronze(spark, [game(3)], "2022-03"), AT), str(tmp_path))
    pages.write_pages(pages.paginate(bronze(spark, [game(4)]), AT), str(tmp_path))
    assert landed_ids(spark, tmp_path) == [("2022-02", 4), ("2022-03", 3)]


def test_a_month_landed_without_games_loses_its_pages(spark, tmp_path):
    raw = str(tmp_path / "raw")
    both = bronze(spark, [game(1)]).union(bronze(spark, [game(2)], "2022-03"))
    months = ["2022-02", "2022-03"]
    for games in (both, both.filter("date = '2022-03'")):
        pages.write_pages(pages.paginate(games, AT), raw, months=months)
    assert landed_ids(spark, raw, form=pages.ONE_PER_LINE) == [("2022-03", 2)]


# Month tables


def months_of(path):
    return sorted(child.name for child in Path(path).glob("date=*"))


def test_month_lives_in_the_folder_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_months(bronze(spark, [game(1)]), path)
    (file,) = Path(path).glob("date=2022-02/*.parquet")
    assert pq.ParquetFile(file).schema_arrow.names == ["downloaded_at", "game"]
    read = tables.read_bronze(spark, path)
    assert read.columns == BRONZE.names
    assert dict(read.dtypes)["date"] == "string"
    assert read.first().date == "2022-02"


def test_write_touches_only_months_with_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_months(bronze(spark, [game(1)]), path)
    tables.write_months(bronze(spark, [game(2)], "2022-03"), path)
    tables.write_months(bronze(spark, [game(3)]), path)
    assert ids(tables.read_bronze(spark, path)) == [("2022-02", 3), ("2022-03", 2)]


def test_replace_months(spark, tmp_path):
    path = str(tmp_path / "t")
    first = bronze(spark, [game(1), game(2)])
    for month in ("2022-03", "2022-04"):
        first = first.union(bronze(spark, [game(3)], month))
    months = ["2022-02", "2022-03", "2022-04"]
    assert tables.replace_months(spark, first, path, months) == months
    # Fewer rows, none at all, and a month that is not listed.
    again = bronze(spark, [game(1)]).union(bronze(spark, [game(9)], "2022-04"))
    for _ in range(2):
        assert tables.replace_months(spark, again, path, ["2022-02", "2022-03"]) == ["2022-02"]
        assert ids(tables.read_bronze(spark, path)) == [("2022-02", 1), ("2022-04", 3)]
    assert months_of(path) == ["date=2022-02", "date=2022-04"]
    assert not list(Path(path).glob("_staged*")) and not list(Path(path).glob("_replaced*"))


def test_replacing_with_nothing_leaves_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    nothing = bronze(spark, [game(1)]).filter("date = 'never'")
    assert tables.replace_months(spark, nothing, path, ["2022-02"]) == []
    assert tables.read_bronze(spark, path).count() == 0


def test_failing_replace_leaves_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_months(bronze(spark, [game(1)]), path)
    broken = bronze(spark, [game(2)]).withColumn("downloaded_at", F.raise_error(F.lit("no")).cast("timestamp"))
    with pytest.raises(Exception, match="no"):
        tables.replace_months(spark, broken, path, ["2022-02"])
    assert ids(tables.read_bronze(spark, path)) == [("2022-02", 1)]


def test_a_month_that_cannot_be_put_in_place_gets_its_rows_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    both = bronze(spark, [game(1)]).union(bronze(spark, [game(2)], "2022-03"))
    tables.write_months(both, path)
    move = storage.move

    def failing(session, source, target):
        if "_staged" in source and "2022-02" in source:
            raise OSError("store is full")
        move(session, source, target)

    monkeypatch.setattr(storage, "move", failing)
    new = bronze(spark, [game(8)]).union(bronze(spark, [game(9)], "2022-03"))
    with pytest.raises(OSError, match="store is full"):
        tables.replace_months(spark, new, path, ["2022-02", "2022-03"])
    assert ids(tables.read_bronze(spark, path)) == [("2022-02", 1), ("2022-03", 9)]
    assert not list(Path(path).glob("_staged*"))
    monkeypatch.undo()
    tables.replace_months(spark, new, path, ["2022-02", "2022-03"])
    assert ids(tables.read_bronze(spark, path)) == [("2022-02", 8), ("2022-03", 9)]


def test_a_failing_write_leaves_no_folder_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    broken = bronze(spark, [game(2)]).withColumn("downloaded_at", F.raise_error(F.lit("no")).cast("timestamp"))
    with pytest.raises(Exception, match="no"):
        tables.replace_months(spark, broken, path, ["2022-02"])
    assert not list(Path(path).glob("_*"))


def test_a_month_too_big_for_one_task_is_split(spark, tmp_path):
    """Two thirds of the rows are of one month; several tasks write it."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 300_000, 1, 32).select(
        F.current_timestamp().alias("downloaded_at"),
        F.uuid().alias("game"),
        F.when(F.col("id") % 3 == 0, F.format_string("1999-%02d", (F.col("id") % 12 + 1)))
        .otherwise("2000-01")
        .alias("date"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "256k")
    try:
        tables.write_months(rows, path, compact=True)
    finally:
        spark.conf.unset(setting)
    hot = [pq.ParquetFile(file).metadata.num_rows for file in Path(path).glob("date=2000-01/*.parquet")]
    assert sum(hot) == 200_000
    assert max(hot) <= 200_000 / tables.SPREAD
    assert len(hot) > tables.SPREAD
    assert spark.read.parquet(path).count() == 300_000


def test_silver_table(spark, tmp_path):
    path = str(tmp_path / "t")
    written = to_silver(feed.games(spark, FOLDER))
    tables.write_months(written, path, compact=True)
    read = tables.read_silver(spark, path)
    assert read.schema == SILVER
    assert read.exceptAll(written).count() == written.exceptAll(read).count() == 0


def test_mart_is_one_file(spark, tmp_path):
    mart = spark.range(0, 20, 1, 8).withColumnRenamed("id", "brand")
    for _ in range(2):
        tables.write_mart(mart, str(tmp_path), "agg_brands")
    assert len(list(tmp_path.glob("agg_brands/*.parquet"))) == 1
    assert tables.read_mart(spark, str(tmp_path), "agg_brands").count() == 20


def test_mapping_as_csv(spark, tmp_path):
    path = str(tmp_path / "mapping")
    tables.write_mapping(console_mapping(spark), path)
    assert sorted(tuple(row) for row in tables.read_mapping(spark, path).collect()) == sorted(CONSOLE_MAPPING)


def test_mapping_written_by_hand(spark, tmp_path):
    file = tmp_path / "mapping.csv"
    file.write_text("console_name,brand,is_handheld\nXbox Series S/X,Microsoft,FALSE\nPSP,Sony,TRUE\n")
    assert [tuple(row) for row in tables.read_mapping(spark, str(file)).collect()] == [
        ("Xbox Series S/X", "Microsoft", False),
        ("PSP", "Sony", True),
    ]
    file.write_text("console_name,owner,is_handheld\nPSP,Sony,TRUE\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_mapping(spark, str(file)).collect()


# Folders


def test_storage(spark, tmp_path):
    root = str(tmp_path / "a")
    assert not storage.exists(spark, root)
    assert storage.child_names(spark, root) == []
    assert storage.delete(spark, root) is False
    (tmp_path / "a" / "b").mkdir(parents=True)
    storage.move(spark, f"{root}/b", f"{root}/c/d")
    assert storage.child_names(spark, root) == ["c"]
    with pytest.raises(Exception):
        storage.move(spark, f"{root}/missing", f"{root}/e")
    assert storage.delete(spark, root) is True
    assert not storage.exists(spark, root)


def test_file_pattern(spark, tmp_path):
    land(tmp_path, "2022-02", [game(1)])
    (tmp_path / "date=2022-02" / "notes.json").write_text("no page")
    form = pages.PageFormat(file_pattern="page_*.json")
    assert landed_ids(spark, tmp_path, form=form) == [("2022-02", 1)]


def test_layout():
    assert Layout.of("local", "/work/games") == Layout.local("/work/games")
    assert Layout.of("prod", "lake") == Layout.bucket("lake")
    with pytest.raises(ValueError, match="staging"):
        Layout.of("staging", "lake")
    assert Layout.local("/work/games/").raw == "/work/games/data/raw"
    layout = Layout.bucket("lake")
    assert layout.bronze == "s3a://lake/bronze"
    assert layout.build("v1").gold == "s3a://lake/builds/v1/gold"
