import time
from datetime import datetime, timezone

import pytest
from helpers import AT, game, land
from pyspark.sql import functions as F

from scorelake import job
from scorelake import order_feed as feed
from scorelake.functions import month_calendar
from scorelake.operators.quality import QualityGateError
from scorelake.plans import bronze, dashboard, end_to_end, raw, refresh
from scorelake.seeds import ALL_MONTHS_FETCHED, ALL_MONTHS_WROTE, CONSOLE_MAPPING, console_mapping
from scorelake.sources import storage
from scorelake.schemas import GAME
from scorelake.sources.layout import Layout
from scorelake.queries import QUERIES
from scorelake.sources.pages import ONE_PER_FILE, ONE_PER_LINE, PageFormat, read_pages
from scorelake.sources.tables import read_bronze, read_mart, read_silver

FOLDER = "/root/testdata/sf0.001"
ALL_NAMES = [row[0] for row in CONSOLE_MAPPING]


def statuses(report):
    return {row.month: row.status for row in report.collect()}


def ids(spark, layout):
    rows = read_bronze(spark, layout.bronze).select("date", "game.id").collect()
    return sorted((row.date, row.id) for row in rows)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def test_backfill_reports_every_month(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-01", [game(1)], [game(2), game(3)])
    land(tmp_path / "raw", "2022-02", [])
    land(tmp_path / "raw", "2022-05", [game(5)])
    report = bronze.backfill(spark, layout.raw, layout.bronze, "2022-01", "2022-04")
    assert statuses(report) == {
        "2022-01": "loaded",
        "2022-02": "empty",
        "2022-03": "empty",
        "2022-04": "empty",
    }
    assert ids(spark, layout) == [("2022-01", 1), ("2022-01", 2), ("2022-01", 3)]
    assert [row.value for row in bronze.failed_months_text(report).collect()] == [ALL_MONTHS_WROTE]


def test_unreadable_months_keep_their_rows_and_others_load(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-01", [game(1)])
    land(tmp_path / "raw", "2022-02", [game(2)])
    bronze.load_months(spark, layout.raw, layout.bronze, ["2022-01", "2022-02"])
    land(tmp_path / "raw", "2022-01", [game(3)])
    land(tmp_path / "raw", "2022-02", [game(4)], [game(5, score="high")])
    land(tmp_path / "raw", "2022-03", [game("no number")])
    months = ["2022-01", "2022-02", "2022-03"]
    report = bronze.load_months(spark, layout.raw, layout.bronze, months)
    assert statuses(report) == {"2022-01": "loaded", "2022-02": "failed", "2022-03": "failed"}
    assert ids(spark, layout) == [("2022-01", 3), ("2022-02", 2)]
    path = str(tmp_path / "failed")
    bronze.write_failed_months(report, path, ALL_MONTHS_FETCHED)
    assert [row.value for row in spark.read.text(path).collect()] == ["2022-02", "2022-03"]


def test_reloading_changes_nothing(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-01", [game(1)], [game(2)])
    for _ in range(2):
        bronze.load_months(spark, layout.raw, layout.bronze, ["2022-01"])
        assert ids(spark, layout) == [("2022-01", 1), ("2022-01", 2)]


def test_other_errors_are_not_taken_for_bad_pages(spark, tmp_path, layout):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bronze.load_months(spark, str(tmp_path / "nowhere"), layout.bronze, ["2022-01"])


def test_landed_and_loaded_by_default_nothing_is_lost(spark, layout):
    games = feed.games(spark, FOLDER)
    months = [row.month for row in month_calendar(spark, *feed.months_around(spark, FOLDER)).collect()]
    raw.land_months(spark, games, layout.raw, months)
    report = bronze.load_months(spark, layout.raw, layout.bronze, months)
    assert set(statuses(report).values()) == {"loaded", "empty"}
    scored = games.filter("game.metacritic BETWEEN 1 AND 100").select("date", "game.id").collect()
    assert ids(spark, layout) == sorted((row.date, row.id) for row in scored)
    assert bronze.unreconciled(spark, layout.raw, layout.bronze, report).count() == 0


def test_pages_in_another_form_fail_their_month(spark, tmp_path, layout):
    source = source_of(spark, [game(1, 90, released="2022-01-31"), game(2, 90, released="2022-02-28")])
    months = ["2022-01", "2022-02"]
    raw.land_months(spark, source, layout.raw, months, AT)
    land(tmp_path / "raw", "2022-03", [game(3)])
    report = bronze.load_months(spark, layout.raw, layout.bronze, [*months, "2022-03"], ONE_PER_FILE)
    assert statuses(report) == {"2022-01": "failed", "2022-02": "failed", "2022-03": "loaded"}


def test_an_error_body_fails_the_month_and_keeps_its_rows(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-01", [game(1)])
    bronze.load_months(spark, layout.raw, layout.bronze, ["2022-01"])
    (tmp_path / "raw" / "date=2022-01" / "page_1.json").write_text('{"detail": "too many requests"}')
    report = bronze.load_months(spark, layout.raw, layout.bronze, ["2022-01"])
    assert statuses(report) == {"2022-01": "failed"}
    assert ids(spark, layout) == [("2022-01", 1)]


def test_an_unreadable_file_fails_its_month_only(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-01", [game(1)])
    land(tmp_path / "raw", "2022-02", [game(2)])
    land(tmp_path / "raw", "2022-03", [game("no number")])
    (tmp_path / "raw" / "date=2022-02" / "page_2.json.gz").write_text("not compressed")
    form = PageFormat(file_pattern="*.json*")
    months = ["2022-01", "2022-02", "2022-03", "2022-04"]
    report = bronze.load_months(spark, layout.raw, layout.bronze, months, form)
    assert statuses(report) == {"2022-01": "loaded", "2022-02": "failed", "2022-03": "failed", "2022-04": "empty"}
    assert ids(spark, layout) == [("2022-01", 1)]


def test_games_that_do_not_arrive_are_noticed(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    land(tmp_path / "raw", "2022-03", [game(7)])
    report = bronze.load_months(spark, layout.raw, layout.bronze, ["2022-02", "2022-03"])
    land(tmp_path / "raw", "2022-02", [game(9)])
    differing = bronze.unreconciled(spark, layout.raw, layout.bronze, report).collect()
    assert [tuple(row) for row in differing] == [("2022-02", 1, 2)]


def test_months_outside_a_backfill_are_told(spark, tmp_path, layout, capsys):
    land(tmp_path / "raw", "2021-12", [game(1)])
    land(tmp_path / "raw", "2022-02", good_games())
    assert bronze.months_outside(spark, layout.raw, "2022-01", "2022-03") == ["2021-12"]
    job.main(["backfill", "--root", layout.root, "--first", "2022-01", "--last", "2022-03"], spark)
    assert "2021-12" in capsys.readouterr().out


def test_the_window_of_the_feed_follows_the_orders(spark, tmp_path):
    orders = feed.table(spark, FOLDER, "orders")
    late = orders.limit(1).withColumn("o_orderdate", F.lit("2011-05-06").cast(orders.schema["o_orderdate"].dataType))
    orders.unionAll(late).write.parquet(str(tmp_path / "orders.parquet"))
    assert feed.months_around(spark, str(tmp_path)) == ("1994-12", "2011-06")
    loaded = QUERIES["bronze_games"](spark, str(tmp_path))
    assert loaded.filter("date = '2011-05'").count() == 1
    assert loaded.count() == orders.count() + 1


def test_the_build_published_last_counts_not_the_one_started_last(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    first = end_to_end.run(spark, layout, ["2022-02"])[1].root.rsplit("/", 1)[1]
    older = "20000101T000000000000-aaaaaaaa"
    storage.write_text(spark, f"{layout.builds}/{older}/_finished", older)
    refresh._publish(spark, layout, older)
    assert refresh.current_build(spark, layout) == layout.build(older)
    assert refresh.drop_old_builds(spark, layout, keep=1) == [first]


def test_builds_that_are_still_written_stay(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    end_to_end.run(spark, layout, ["2022-02"])
    writing, given_up = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-x", "20000101T000000000000-x"
    for name in (writing, given_up):
        storage.write_text(spark, f"{layout.builds}/{name}/silver/part", "rows")
    assert refresh.drop_old_builds(spark, layout) == [given_up]
    assert writing in storage.child_names(spark, layout.builds)


def test_landing_job(spark, tmp_path, layout):
    source_of(spark, [game(1, 90, released="2022-01-31")]).write.parquet(str(tmp_path / "games"))
    job.main(["land", "--root", layout.root, "--source", str(tmp_path / "games"), "--first", "2022-01", "--last", "2022-02"], spark)
    assert [row.value for row in spark.read.text(layout.failed_landings).collect()] == [ALL_MONTHS_FETCHED]
    assert read_pages(spark, layout.raw).count() == 1


def test_month_report(spark):
    calendar = month_calendar(spark, "2022-01", "2022-03")
    loaded = spark.createDataFrame([("2022-01",)], "month string")
    failed = spark.createDataFrame([("2022-03",)], "month string")
    report = bronze.month_report(calendar, loaded, failed)
    assert statuses(report) == {"2022-01": "loaded", "2022-02": "empty", "2022-03": "failed"}


def test_landing_a_source(spark, layout):
    rows = [
        game(1, 90, released="2022-01-31"),
        game(2, None, released="2022-01-31"),
        game(3, 0, released="2022-01-01"),
        game(4, 100, released="2022-02-28"),
        game(5, 50, released="2022-03-01"),
        game(6, 1, released="2022-01-01"),
        game(7, 1, released=None),
    ]
    months = ["2022-01", "2022-02", "2022-04"]
    for form in (ONE_PER_LINE, ONE_PER_FILE):
        source = source_of(spark, rows)
        report = raw.land_months(spark, source, layout.raw, months, AT, form)
        assert statuses(report) == {"2022-01": "loaded", "2022-02": "loaded", "2022-04": "empty"}
        pages = read_pages(spark, layout.raw, form=form).select("date", "results.id").collect()
        assert sorted((row.date, row.id) for row in pages) == [("2022-01", [6, 1]), ("2022-02", [4])]
    text = bronze.failed_months_text(report, ALL_MONTHS_FETCHED)
    assert [row.value for row in text.collect()] == [ALL_MONTHS_FETCHED]
    # A month the source no longer has loses its pages.
    raw.land_months(spark, source_of(spark, rows[3:4]), layout.raw, months, AT)
    assert [row.date for row in read_pages(spark, layout.raw, form=ONE_PER_LINE).collect()] == ["2022-02"]


def source_of(spark, rows):
    return spark.createDataFrame([(row,) for row in rows], f"game {GAME.simpleString()}").coalesce(1)


def good_games():
    return [game(1, 90, ALL_NAMES), game(2, 70, ["Wii", "PSP", "Dreamcast"])]


def test_end_to_end(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    report, build, checks = end_to_end.run(spark, layout, ["2022-02", "2022-03"])
    assert statuses(report) == {"2022-02": "loaded", "2022-03": "empty"}
    assert len(checks) == 12
    brands = read_mart(spark, build.gold, refresh.BRAND_MART).collect()
    assert {tuple(row) for row in brands} == {
        ("Nintendo", 80.0, 2, 1, 50.0),
        ("Sony", 80.0, 2, 1, 50.0),
        ("Microsoft", 90.0, 1, 1, 100.0),
    }
    consoles = read_mart(spark, build.gold, refresh.CONSOLE_MART)
    assert consoles.count() == 20
    assert consoles.filter("console_name = 'Wii'").first().avg_metacritic_score == 80.0
    assert refresh.current_build(spark, layout) == build
    assert read_silver(spark, build.silver).count() == 2
    mart = dashboard.load_mart(spark, layout, refresh.BRAND_MART)
    assert sorted(row.brand for row in mart.collect()) == ["Microsoft", "Nintendo", "Sony"]


@pytest.mark.parametrize(
    "bad, check",
    [
        ([game(2, None)], "not_null silver_games.metacritic_score: 1"),
        ([game(1, 50)], "unique silver_games.game_id: 1"),
    ],
)
def test_failing_checks_keep_the_last_good_build(spark, tmp_path, layout, bad, check):
    land(tmp_path / "raw", "2022-02", [game(1, 90, ALL_NAMES)])
    _, good, _ = end_to_end.run(spark, layout, ["2022-02"])
    land(tmp_path / "raw", "2022-03", bad)
    with pytest.raises(QualityGateError, match=check):
        end_to_end.run(spark, layout, ["2022-03"])
    assert refresh.current_build(spark, layout) == good
    assert read_silver(spark, good.silver).count() == 1
    failed = [name for name in storage.child_names(spark, layout.builds) if name not in good.root]
    assert not any(storage.exists(spark, layout.build(name).gold) for name in failed)


def test_coverage_gates_the_marts(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", [game(1, 90, ALL_NAMES[1:])])
    with pytest.raises(QualityGateError, match="coverage console_mapping.console_name: 1"):
        end_to_end.run(spark, layout, ["2022-02"])
    assert refresh.current_build(spark, layout) is None
    assert refresh.drop_old_builds(spark, layout) == []
    with pytest.raises(LookupError):
        dashboard.load_mart(spark, layout, refresh.BRAND_MART)


def test_mapping_gates_everything(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    bronze.load_months(spark, layout.raw, layout.bronze, ["2022-02"])
    with pytest.raises(QualityGateError, match="accepted_values console_mapping.brand: 1"):
        refresh.refresh(spark, layout, console_mapping(spark), ["Sony", "Nintendo"])
    assert not storage.exists(spark, layout.builds)


def test_old_builds_go_only_when_newer_ones_are_published(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    builds = [end_to_end.run(spark, layout, ["2022-02"])[1] for _ in range(2)]
    time.sleep(0.01)
    builds.append(refresh.refresh(spark, layout, console_mapping(spark))[0])
    assert refresh.drop_old_builds(spark, layout) == [builds[0].root.rsplit("/", 1)[1]]
    assert refresh.drop_old_builds(spark, layout) == []
    assert refresh.current_build(spark, layout) == builds[2]
    assert read_silver(spark, builds[1].silver).count() == 2


def test_threshold_reaches_the_marts(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    _, build, _ = end_to_end.run(spark, layout, ["2022-02"], threshold=70)
    brands = read_mart(spark, build.gold, refresh.BRAND_MART)
    assert {row.percentage_of_highly_rated_games for row in brands.collect()} == {100.0}


def test_job(spark, tmp_path, layout):
    land(tmp_path / "raw", "2022-02", good_games())
    options = ["--root", layout.root, "--first", "2022-01", "--last", "2022-03"]
    job.main(["run", *options], spark)
    assert dashboard.load_mart(spark, layout, refresh.CONSOLE_MART).toPandas().shape == (20, 7)
    lines = [row.value for row in spark.read.text(layout.failed_months).collect()]
    assert lines == [ALL_MONTHS_WROTE]
    file = tmp_path / "mapping.csv"
    file.write_text("console_name,brand,is_handheld\nDreamcast,Sega,false\n")
    job.main(
        ["refresh", "--root", layout.root, "--mapping", str(file), "--brands", "Sega", "--threshold", "70"],
        spark,
    )
    (mart,) = dashboard.load_mart(spark, layout, refresh.BRAND_MART).toPandas().values.tolist()
    assert mart == ["Sega", 70.0, 1, 1, 100.0]


def test_jobs_that_update_and_audit(spark, tmp_path, layout, capsys):
    land(tmp_path / "raw", "2022-02", good_games())
    options = ["--root", layout.root, "--first", "2022-01", "--last", "2022-03"]
    job.main(["backfill", *options], spark)
    for told in ("changed: 2022-02", "changed: nothing"):
        job.main(["update", *options], spark)
        assert told in capsys.readouterr().out
    job.main(["audit", *options], spark)
    assert "2022" not in capsys.readouterr().out
    land(tmp_path / "raw", "2022-02", [game(9)])
    job.main(["audit", *options], spark)
    assert "2022-02: 1 games in raw, 2 in bronze" in capsys.readouterr().out
