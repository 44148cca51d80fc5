import random
import re

import pytest
from helpers import bronze, game
from pyspark.sql import functions as F

from scorelake.operators import games as ops
from scorelake.operators import marts, quality
from scorelake.plans.changes import KeptMarts
from scorelake.seeds import CONSOLE_MAPPING, console_mapping
from scorelake.sources import snapshots, tables
from scorelake.sources.runs import SumRuns, ordered

MONTHS = [f"2022-{month:02d}" for month in range(1, 7)]
NAMES = [row[0] for row in CONSOLE_MAPPING][:6] + ["unknown", None]
KEYS = [("key", "string"), ("more", "int")]


def rows(frame):
    return sorted(map(str, (tuple(row) for row in frame.collect())))


def random_games(rng):
    """A few ids, so that months, scores and consoles share games."""
    return [
        game(
            rng.choice([None, *range(1, 15)]),
            rng.choice([None, 50, 79, 80, 95]),
            rng.choice([None, [], rng.choices(NAMES, k=rng.randint(1, 5))]),
        )
        for _ in range(rng.randint(0, 25))
    ]


def load(spark, path, by_month):
    frame = None
    for month, games in by_month.items():
        one = bronze(spark, games or [game(1)], month)
        one = one if games else one.filter("false")
        frame = one if frame is None else frame.unionAll(one)
    snapshots.replace_months(spark, frame, path, list(by_month))


def test_equal_to_a_full_refresh_over_random_replacements(spark, tmp_path):
    path, rng = str(tmp_path / "bronze"), random.Random(6)
    mapping = console_mapping(spark)
    kept = KeptMarts(spark, path, str(tmp_path / "kept"), mapping, buckets=3)
    for turn in range(7):
        months = MONTHS if turn == 0 else rng.sample(MONTHS, rng.randint(1, 3))
        load(spark, path, {month: random_games(rng) for month in months})
        assert set(kept.update()) <= set(months)
        silver = ops.to_silver(tables.read_bronze(spark, path))
        by_console = ops.games_by_console(silver, mapping)
        assert rows(kept.brand_mart()) == rows(marts.brand_mart(by_console))
        assert rows(kept.console_mart()) == rows(marts.console_mart(by_console))
        assert rows(kept.repeated_games()) == rows(quality.repeated_values(silver, "game_id"))
        assert kept.brand_mart().columns == marts.brand_mart(by_console).columns
        assert kept.update() == []
    # Seven changes have been merged to runs of four, two and one.
    assert [len(level) for level in kept.kept().levels["games"]] == [1, 1, 1]


def test_another_mapping_and_lost_rows_build_anew(spark, tmp_path):
    path, folder = str(tmp_path / "bronze"), str(tmp_path / "kept")
    load(spark, path, {"2022-01": [game(1, 90, ["Wii"])], "2022-02": [game(2, 70, ["Wii", "PSP"])]})
    kept = KeptMarts(spark, path, folder, console_mapping(spark), buckets=2)
    with pytest.raises(LookupError):
        kept.brand_mart()
    assert kept.update() == ["2022-01", "2022-02"]
    other = console_mapping(spark).filter("console_name = 'PSP'")
    fewer = KeptMarts(spark, path, folder, other, buckets=2)
    assert fewer.update() == ["2022-01", "2022-02"]
    assert [row.console_name for row in fewer.console_mart().collect()] == ["PSP"]
    load(spark, path, {"2022-02": [game(2, 70, ["Wii"])]})
    snapshots.drop_old_versions(spark, path, snapshots.timedelta(0))
    assert fewer.update() == ["2022-01", "2022-02"] or fewer.console_mart().count() == 0
    assert fewer.console_mart().count() == 0


def test_nothing_loaded_and_plain_months(spark, tmp_path):
    path = str(tmp_path / "bronze")
    kept = KeptMarts(spark, path, str(tmp_path / "kept"), console_mapping(spark), buckets=2)
    load(spark, path, {"2022-01": []})
    assert kept.update() == [] and kept.brand_mart().count() == kept.repeated_games().count() == 0
    tables_path = str(tmp_path / "plain")
    tables.write_months(bronze(spark, [game(1)]), tables_path)
    with pytest.raises(ValueError, match="without a version"):
        KeptMarts(spark, tables_path, str(tmp_path / "k"), console_mapping(spark)).update()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def store_of(spark, tmp_path, runs):
    store = SumRuns(spark, str(tmp_path / "runs"), KEYS, ["n"], buckets=4)
    for start, end in runs:
        change = spark.range(start, end).select(
            F.col("id").cast("string").alias("key"), (F.col("id") % 3).cast("int").alias("more"), F.lit(1).cast("bigint").alias("n")
        )
        store.place(store.write(store.summed(change)))
    return store


def test_runs_are_not_shuffled_to_be_looked_up_or_merged(spark, tmp_path):
    store = store_of(spark, tmp_path, [(0, 1000), (500, 1500), (900, 1600)])
    assert [len(level) for level in store.levels] == [1, 1]
    change = store.write(spark.createDataFrame([("950", 2, 5), ("1599", 0, -1), ("9999", 0, 7)], "key string, more int, n bigint"))
    with ordered(spark):
        found = store.before(change)
        looked_up, merging = plan(found), plan(store.merged(*store.runs()))
        assert sorted(map(tuple, found.collect())) == [("1599", 0, 1, 0), ("950", 2, 3, 8), ("9999", 0, 0, 7)]
    for text in (looked_up, merging):
        assert "Exchange" not in text and "SortMergeJoin" in text
        # Files are read in the order they were written in.
        assert not re.search(r"\bSort \[", text)
    store.place(change)
    assert store.total().filter("key = '1599'").count() == 0
    assert store.total().count() == 1600


def test_a_store_is_read_by_another_session(spark, tmp_path):
    store = store_of(spark, tmp_path, [(0, 10)])
    for run in store.runs():
        spark.sql(f"DROP TABLE run_{run}")
    again = SumRuns(spark, store.folder, KEYS, ["n"], store.levels, buckets=4)
    assert again.total().count() == 10
    store.write(again.total())
    again.drop_others()
    assert len([name for name in tmp_path.glob("runs/*")]) == 1 and again.total().count() == 10


def test_total_of_several_runs(spark, tmp_path):
    store = store_of(spark, tmp_path, [(0, 10), (5, 15), (8, 20)])
    assert len(store.runs()) == 2
    found = {int(row.key): row.n for row in store.total().collect()}
    assert found == {n: sum(n in range(*run) for run in ((0, 10), (5, 15), (8, 20))) for n in range(20)}
