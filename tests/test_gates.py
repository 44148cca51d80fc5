import pytest
from helpers import game, land
from pyspark.sql import functions as F

from scorelake.operators import games as ops
from scorelake.operators import joins
from scorelake.operators.quality import QualityGateError, count_check
from scorelake.plans import bronze, dashboard, refresh
from scorelake.seeds import CONSOLE_MAPPING, console_mapping
from scorelake.sources import tables
from scorelake.sources.layout import Layout

ALL_NAMES = [row[0] for row in CONSOLE_MAPPING]


def load(spark, tmp_path, score):
    layout = Layout(str(tmp_path))
    land(tmp_path / "raw", "2022-02", [game(1, score, ALL_NAMES)])
    bronze.load_months(spark, layout.raw, layout.bronze, ["2022-02"])
    return layout


def low_consoles(mart):
    low = mart.filter("avg_metacritic_score < 60")
    return count_check(low, "score", refresh.CONSOLE_MART, "avg_metacritic_score")


def test_what_follows_a_failed_check_does_not_stand():
    assert refresh.standing(set()) == list(refresh.MADE_FROM)
    assert refresh.standing({refresh.CONSOLE_MART}) == ["console_mapping", refresh.SILVER, refresh.BRAND_MART]
    assert refresh.standing({"console_mapping"}) == [refresh.SILVER]
    assert refresh.standing({refresh.SILVER}) == ["console_mapping"]
    chain = {"a": (), "b": ("a",), "c": ("b",), "d": ("a", "c")}
    assert refresh.standing({"b"}, chain) == ["a"]


def test_a_failed_console_check_leaves_the_brand_mart_publishable(spark, tmp_path):
    checks = {refresh.CONSOLE_MART: low_consoles}
    layout = load(spark, tmp_path, 90)
    good, _ = refresh.refresh(spark, layout, console_mapping(spark), more_checks=checks)
    load(spark, tmp_path, 50)
    with pytest.raises(QualityGateError, match="score agg_consoles.avg_metacritic_score: 20"):
        refresh.refresh(spark, layout, console_mapping(spark), more_checks=checks)
    scores = [
        {row.avg_metacritic_score for row in dashboard.load_mart(spark, layout, name).collect()}
        for name in (refresh.BRAND_MART, refresh.CONSOLE_MART)
    ]
    assert scores == [{50.0}, {90.0}]
    assert refresh.current_build(spark, layout) == good
    # Both builds are still read.
    assert refresh.drop_old_builds(spark, layout, keep=1) == []
    history = refresh.check_history(spark, layout)
    assert history.select("version").distinct().count() == 2
    failed = history.filter("status = 'fail'").collect()
    assert [(row.check, row.table, row.failures) for row in failed] == [("score", "agg_consoles", 20)]
    assert history.filter("table = 'agg_brands'").count() == 4


def test_a_failed_mapping_is_in_the_history(spark, tmp_path):
    layout = load(spark, tmp_path, 90)
    with pytest.raises(QualityGateError):
        refresh.refresh(spark, layout, console_mapping(spark), ["Sony"])
    assert refresh.check_history(spark, layout).filter("status = 'fail'").count() == 1


def test_a_mart_as_a_local_frame(spark, tmp_path):
    layout = load(spark, tmp_path, 90)
    refresh.refresh(spark, layout, console_mapping(spark))
    frame = dashboard.local_mart(spark, layout, refresh.CONSOLE_MART)
    assert frame.shape == (20, 7) and set(frame["number_of_games"]) == {1}
    with pytest.raises(ValueError, match="more than 19 rows"):
        dashboard.local_mart(spark, layout, refresh.CONSOLE_MART, most_rows=19)


def test_only_hot_keys_are_copied(spark):
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, "warm").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"),
        F.col("id").alias("by"),
    )
    names = [("hot",), ("warm",), *((f"k{n}",) for n in range(4000))]
    dimension = spark.createDataFrame(names, "key string").withColumn("value", F.length("key"))
    assert joins.hot_keys(facts, "key") == ["hot", "warm"]
    joined = joins.join_dimension(facts, dimension, "key", "by", broadcast_bytes=0)
    plain = facts.join(dimension, "key")
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).count() == plain.exceptAll(joined).count() == 0
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "hot" in text and "warm" in text and "explode" in text
    even = facts.filter("key like 'k%'")
    assert joins.hot_keys(even, "key") == [] and joins.hot_keys(facts.filter("false"), "key") == []
    text = joins.join_dimension(even, dimension, "key", "by", broadcast_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in text


def test_a_stored_slice_is_sorted_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = spark.range(5000).select(
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 700).cast("int")), "yyyy-MM").alias("date"),
        F.lit("x").alias("game_name"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 700).cast("int")).alias("release_date"),
        (F.col("id") % 101).cast("int").alias("metacritic_score"),
        F.col("id").cast("string").alias("game_id"),
        *(F.lit(None).cast("array<string>").alias(name) for name in ("console_names", "genre_names")),
        F.lit(None).cast("string").alias("esrb_rating"),
    )
    tables.write_months(rows, path)
    found = ops.stored_slice(spark, path, "2020-03", "2021-02")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "PushedFilters: [IsNotNull" in text
    keys = [(row.release_date, row.game_id) for row in found.collect()]
    expected = ops.source_slice(tables.read_silver(spark, path), "2020-03", "2021-02")
    assert keys == sorted(keys) == [(row.release_date, row.game_id) for row in expected.collect()]
    assert len(keys) > 1000
    # Months larger than a task are range-sorted, each by itself.
    order = ["release_date", "game_id"]
    large = tables.read_in_order(spark, path, "2020-03", "2021-02", order, task_bytes=1)
    keys = [(row.release_date, row.game_id) for row in large.collect()]
    assert keys == sorted(keys) and len(keys) > 1500
    assert ops.stored_slice(spark, path, "1999-01", "1999-02").count() == 0
