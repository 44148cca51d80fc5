import threading
from datetime import timedelta

import pytest
from helpers import AT, bronze, game, land
from pyspark.sql import functions as F

from scorelake.plans import bronze as plan
from scorelake.sources import pages, snapshots, tables

MONTHS = ["2022-02", "2022-03", "2022-04"]


def rows(spark, ids):
    """One game for each (month, id)."""
    frame = None
    for month, id in ids:
        one = bronze(spark, [game(id)], month)
        frame = one if frame is None else frame.unionAll(one)
    return frame


def ids(frame):
    return sorted((row.date, row.id) for row in frame.select("date", "game.id").collect())


def held(spark, path):
    return ids(tables.read_bronze(spark, path))


def test_months_change_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("2022-02", 1), ("2022-02", 2), ("2022-03", 3), ("2022-04", 4)]
    assert snapshots.replace_months(spark, rows(spark, first), path, MONTHS) == MONTHS
    again = rows(spark, [("2022-02", 8), ("2022-04", 9)])
    for _ in range(2):
        assert snapshots.replace_months(spark, again, path, MONTHS[:2]) == ["2022-02"]
        assert held(spark, path) == [("2022-02", 8), ("2022-04", 4)]
    assert tables.read_bronze(spark, path).filter("date = '2022-04'").count() == 1


def test_plain_months_are_read_until_they_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_months(rows(spark, [("2022-02", 1), ("2022-03", 2)]), path)
    snapshots.replace_months(spark, rows(spark, [("2022-03", 3)]), path, ["2022-03"])
    assert held(spark, path) == [("2022-02", 1), ("2022-03", 3)]
    tables.write_months(rows(spark, [("2022-02", 5), ("2022-05", 6)]), path)
    assert held(spark, path) == [("2022-02", 5), ("2022-03", 3), ("2022-05", 6)]
    assert "date=2022-03" in snapshots.drop_old_versions(spark, path, timedelta(0))
    assert held(spark, path) == [("2022-02", 5), ("2022-03", 3), ("2022-05", 6)]


def test_nothing_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    none = rows(spark, [("2022-02", 1)]).filter("false")
    assert snapshots.replace_months(spark, none, path, MONTHS) == []
    snapshots.replace_months(spark, rows(spark, [("2022-02", 1)]), path, MONTHS)
    snapshots.replace_months(spark, none, path, MONTHS)
    assert held(spark, path) == []


def test_a_load_that_fails_is_seen_by_nobody(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace_months(spark, rows(spark, [("2022-02", 1)]), path, MONTHS)
    broken = rows(spark, [("2022-02", 2)]).withColumn("downloaded_at", F.raise_error(F.lit("no")).cast("timestamp"))
    with pytest.raises(Exception, match="no"):
        snapshots.replace_months(spark, broken, path, MONTHS)
    # Written in full, but its driver was lost before the commit.
    snapshots.write(rows(spark, [("2022-02", 3)]), path, snapshots.new_version())
    assert held(spark, path) == [("2022-02", 1)]
    assert len(snapshots.drop_old_versions(spark, path)) == 0
    assert len(snapshots.drop_old_versions(spark, path, timedelta(0))) == 1
    assert held(spark, path) == [("2022-02", 1)]


def test_readers_find_the_old_or_the_new_months_all_the_time(spark, tmp_path):
    """Each load writes its number into every row of two months; a reader finds one number in both."""
    path = str(tmp_path / "t")
    months = MONTHS[:2]

    def load(number):
        table = spark.range(50).select(
            F.lit(AT).cast("timestamp").alias("downloaded_at"),
            F.from_json(F.format_string('{"id": %d}', F.lit(number)), pages.GAME).alias("game"),
            F.lit(None).cast("string").alias("document"),
            F.element_at(F.array(*map(F.lit, months)), (F.col("id") % 2 + 1).cast("int")).alias("date"),
        )
        snapshots.replace_months(spark, table, path, months)

    load(0)
    found, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            counted = tables.read_bronze(spark, path).groupBy("date", "game.id").count().collect()
            found.append(sorted((row["date"], row["id"], row["count"]) for row in counted))

    reader = threading.Thread(target=read)
    reader.start()
    for number in range(1, 7):
        load(number)
    stop.set()
    reader.join()
    assert len(found) > 1
    for seen in found:
        (number,) = {id for _, id, _ in seen}
        assert seen == [(month, number, 25) for month in months]


def test_a_reader_that_has_begun_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace_months(spark, rows(spark, [("2022-02", 1)]), path, MONTHS)
    before = tables.read_bronze(spark, path)
    snapshots.replace_months(spark, rows(spark, [("2022-02", 2)]), path, MONTHS)
    assert ids(before) == [("2022-02", 1)] and held(spark, path) == [("2022-02", 2)]


def test_commits_are_folded(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(3 * snapshots.MOST_COMMITS):
        month = f"20{number % 40:02d}-01"
        snapshots.commit(spark, path, {month: f"v{number}", "2099-01": None})
    assert len(list((tmp_path / "t" / "_snapshots").glob("[!.]*"))) <= snapshots.MOST_COMMITS + 1
    placed = snapshots.current(spark, path)
    assert placed.pop("2099-01") is None
    last = {f"20{number % 40:02d}-01": f"v{number}" for number in range(3 * snapshots.MOST_COMMITS)}
    assert placed == last


def test_one_version_for_a_load_and_no_folder_moved(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    moved = []
    move = snapshots.storage.move
    monkeypatch.setattr(snapshots.storage, "move", lambda *a: (moved.append(a[1]), move(*a)))
    snapshots.replace_months(spark, rows(spark, [(month, 1) for month in MONTHS]), path, MONTHS)
    assert len(moved) == 1 and "_snapshots" in moved[0]


# Loads


def statuses(report):
    return {row.month: row.status for row in report.collect()}


def test_outcomes_of_files(spark, tmp_path):
    raw, path = tmp_path / "raw", str(tmp_path / "bronze")
    land(raw, "2022-02", [game(1)], [game(2), game(3)])
    land(raw, "2022-03", [game(4), game(5, score="high")])
    land(raw, "2022-04", [game(6)])
    (raw / "date=2022-04" / "page_2.json").write_text('{"results": [')
    (raw / "date=2022-04" / "page_3.json").write_text("")
    report = plan.load_months(spark, str(raw), path, [*MONTHS, "2022-05"])
    assert statuses(report) == {"2022-02": "loaded", "2022-03": "failed", "2022-04": "failed", "2022-05": "empty"}
    outcomes = plan.file_outcomes(spark, path).collect()
    assert sorted((row.date, row.file.rsplit("/", 1)[1], row.pages, row.games, row.status) for row in outcomes) == [
        ("2022-02", "page_1.json", 1, 1, "read"),
        ("2022-02", "page_2.json", 1, 2, "read"),
        ("2022-03", "page_1.json", 1, 2, "bad"),
        ("2022-04", "page_1.json", 1, 1, "read"),
        ("2022-04", "page_2.json", 1, 0, "bad"),
    ]
    found = plan.quarantined(spark, path, outcomes[0].version).collect()
    assert sorted((row.date, row.complaint) for row in found) == [("2022-03", "game"), ("2022-04", "page")]
    (text,) = [row.document for row in found if row.complaint == "game"]
    assert '"metacritic": "high"' in text


def gzipped(text):
    import gzip

    return gzip.compress(text.encode())


def test_packed_files_that_end_too_early(spark, tmp_path):
    """A page per line or per file: none of a file's pages counts unless all of it can be read."""
    import json

    raw, path = tmp_path / "raw", str(tmp_path / "bronze")
    lines = "\n".join(json.dumps({"results": [game(number)]}) for number in range(2000))
    for month, name, content in (
        ("2022-02", "a.json.gz", gzipped(lines)),
        ("2022-03", "b.json.gz", gzipped(lines)[:-400]),
        ("2022-04", "c.json.gz", b"no pages"),
    ):
        (raw / f"date={month}").mkdir(parents=True)
        (raw / f"date={month}" / name).write_bytes(content)
    form = pages.PageFormat(lines=True, file_pattern="*.json*")
    assert statuses(plan.load_months(spark, str(raw), path, MONTHS, form)) == {
        "2022-02": "loaded",
        "2022-03": "failed",
        "2022-04": "failed",
    }
    assert tables.read_bronze(spark, path).count() == 2000
    page = gzipped(json.dumps({"results": [game(number) for number in range(40)]}))
    for month, content in (("2022-05", page), ("2022-06", page[: len(page) // 2])):
        (raw / f"date={month}").mkdir()
        (raw / f"date={month}" / "page.json.gz").write_bytes(content)
    form = pages.PageFormat(file_pattern="*.json*")
    report = plan.load_months(spark, str(raw), path, ["2022-05", "2022-06"], form)
    assert statuses(report) == {"2022-05": "loaded", "2022-06": "failed"}


def test_jobs_do_not_grow_with_months(spark, tmp_path):
    """Also not when a file of each of several months cannot be read."""
    counts = []
    for number, months in enumerate((3, 12)):
        raw, path = tmp_path / f"raw{number}", str(tmp_path / f"bronze{number}")
        for month in range(1, months + 1):
            land(raw, f"2022-{month:02d}", [game(month)])
            (raw / f"date=2022-{month:02d}" / "x.json.gz").write_text("no page")
        spark.sparkContext.setJobGroup(f"load-{number}", "a load")
        form = pages.PageFormat(file_pattern="*.json*")
        report = plan.load_months(spark, str(raw), path, [f"2022-{month:02d}" for month in range(1, months + 1)], form)
        assert set(statuses(report).values()) == {"failed"}
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"load-{number}")))
    spark.sparkContext._jsc.clearJobGroup()
    assert counts[0] == counts[1]


def test_a_page_with_a_repeated_key_is_loaded(spark, tmp_path):
    raw, path = tmp_path / "raw", str(tmp_path / "bronze")
    land(raw, "2022-02", [game(1)])
    (raw / "date=2022-02" / "page_2.json").write_text('{"results": [{"id": 7}], "note": 1, "results": [{"id": 8, "id": 9}]}')
    assert statuses(plan.load_months(spark, str(raw), path, ["2022-02"])) == {"2022-02": "loaded"}
    assert held(spark, path) == [("2022-02", 1), ("2022-02", 9)]


def test_games_lost_between_pages_and_bronze(spark, tmp_path):
    raw, path = tmp_path / "raw", str(tmp_path / "bronze")
    land(raw, "2022-02", [game(1), game(2)])
    land(raw, "2022-03", [game(3)])
    plan.load_months(spark, str(raw), path, MONTHS)
    assert plan.lost_games(spark, path, MONTHS).count() == 0
    version = snapshots.current(spark, path)["2022-02"]
    folder = f"{snapshots.version_folder(path, version)}/part=rows/date=2022-02"
    kept = tables.read_bronze(spark, path).filter("game.id = 1").drop("date").persist()
    kept.count()
    kept.write.mode("overwrite").parquet(folder)
    kept.unpersist()
    assert [tuple(row) for row in plan.lost_games(spark, path).collect()] == [("2022-02", 2, 1)]


def test_each_game_is_decoded_once(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, "2022-02", [game(1)])
    folders, _ = pages.page_folders(spark, str(raw), None, pages.AS_RECORDED)
    entries = plan._entries(pages.scan_pages(spark, str(raw), folders), pages.AS_RECORDED)
    text = entries._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1 and "variant" not in text.lower()
