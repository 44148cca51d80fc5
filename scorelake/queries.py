"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake import order_feed as feed
from scorelake.functions import (
    count_label,
    month_bounds,
    month_calendar,
    month_key,
    months_between,
    percentage,
    round2,
    to_int,
)
from scorelake.operators import marts, quality
from scorelake.operators import games as ops
from scorelake.plans import bronze, changes, dashboard, end_to_end, raw, refresh
from scorelake.schemas import SILVER
from scorelake.session import work_folder
from scorelake.sources import pages as raw_pages
from scorelake.sources import snapshots, storage, tables
from scorelake.sources.layout import Layout

SLICE = ("1996-01", "1999-12")
REPLACED_MONTHS = [f"1997-{month:02d}" for month in range(1, 13)]
EMPTIED_MONTH = "1997-05"
MISSING_MONTHS = ["1995-02", "1999-07"]
MALFORMED_MONTH = "1996-06"
UNREADABLE_MONTH = "1998-03"
ERROR_MONTH = "2000-02"


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return ops.to_silver(feed.games(spark, folder))


def _by_console(spark: SparkSession, folder: str) -> DataFrame:
    return ops.games_by_console(_silver(spark, folder), feed.console_mapping(spark, folder))


def _scored(games: DataFrame) -> DataFrame:
    return games.filter(F.col("game.metacritic").isNotNull())


def _pages(games: DataFrame) -> DataFrame:
    return raw_pages.paginate(games.select("game", "date"), feed.DOWNLOADED_AT)


def _joined(names: str) -> F.Column:
    """A list as comparable text; a NULL list stays NULL, a NULL element shows."""
    return F.array_join(names, ";", "(none)")


def _months(spark: SparkSession, folder: str) -> list[str]:
    """A month more than the orders have at either end; one row for each month."""
    calendar = month_calendar(spark, *feed.months_around(spark, folder))
    return [row["month"] for row in calendar.collect()]


def _flat(bronze_games: DataFrame, *more: Column) -> DataFrame:
    return bronze_games.select(
        "date",
        F.col("game.id").alias("id"),
        F.col("game.name").alias("name"),
        F.col("game.released").alias("released"),
        F.col("game.metacritic").cast("bigint").alias("metacritic"),
        _joined("game.platforms.platform.name").alias("platforms"),
        _joined("game.genres.name").alias("genres"),
        F.col("game.esrb_rating.name").alias("rating"),
        F.unix_micros("downloaded_at").alias("downloaded_micros"),
        *more,
    )


def _flat_silver(silver: DataFrame) -> DataFrame:
    return silver.withColumn("console_names", _joined("console_names")).withColumn(
        "genre_names", _joined("genre_names")
    )


# Sources


def json_page_scan(spark, folder):
    path = work_folder(spark, "json_page_scan")
    raw_pages.write_pages(_pages(feed.games(spark, folder)), path)
    return _flat(ops.unnest_results(raw_pages.read_pages(spark, path)))


def partition_column_scan(spark, folder):
    path = work_folder(spark, "partition_column_scan")
    raw_pages.write_pages(_pages(feed.games(spark, folder)), path)
    scanned = raw_pages.read_pages(spark, path)
    return scanned.groupBy("date").agg(F.sum(F.size("results")).alias("games"))


def bronze_scan(spark, folder):
    path = work_folder(spark, "bronze_scan")
    tables.write_months(feed.games(spark, folder), path, compact=True)
    return _flat(tables.read_bronze(spark, path))


def gold_scan(spark, folder):
    gold = work_folder(spark, "gold_scan")
    tables.write_mart(marts.console_mart(_by_console(spark, folder)), gold, refresh.CONSOLE_MART)
    return tables.read_mart(spark, gold, refresh.CONSOLE_MART).select("*")


def seed_scan(spark, folder):
    """The CSV dimension, with how often games list each of its consoles."""
    path = work_folder(spark, "seed_scan")
    tables.write_mapping(feed.console_mapping(spark, folder), path)
    listings = (
        ops.unnest_consoles(_silver(spark, folder))
        .groupBy("console_name")
        .agg(F.count("*").alias("listings"))
    )
    listed = F.coalesce("listings", F.lit(0)).alias("listings")
    return (
        tables.read_mapping(spark, path)
        .join(listings, "console_name", "left")
        .select("console_name", "brand", "is_handheld", listed)
    )


def source_slice(spark, folder):
    return ops.source_slice(_silver(spark, folder), *SLICE).select(
        "game_id", "game_name", "release_date", "metacritic_score"
    )


def ordered_slice(spark, folder):
    """The slice out of a stored silver table, months in the order of their folders."""
    path = work_folder(spark, "ordered_slice")
    tables.write_months(_silver(spark, folder), path, compact=True)
    return ops.stored_slice(spark, path, *SLICE).select("game_id", "game_name", "release_date", "metacritic_score")


# Sinks


def partitioned_write(spark, folder):
    path = work_folder(spark, "partitioned_write")
    tables.write_months(feed.games(spark, folder), path, compact=True)
    scanned = tables.read_bronze(spark, path)
    return scanned.groupBy("date").agg(
        F.count("*").alias("games"),
        F.sum("game.metacritic").cast("bigint").alias("score_sum"),
    )


def partition_replace(spark, folder):
    path = work_folder(spark, "partition_replace")
    games = feed.games(spark, folder)
    tables.write_months(games, path, compact=True)
    for _ in range(2):
        snapshots.replace_months(spark, _reloaded(games), path, REPLACED_MONTHS, tables.by_month)
    return tables.read_bronze(spark, path).select(
        "date", F.col("game.id").alias("id"), F.col("game.metacritic").cast("bigint").alias("metacritic")
    )


def _reloaded(games: DataFrame) -> DataFrame:
    return games.filter((F.col("game.metacritic") >= 80) & (F.col("date") != EMPTIED_MONTH))


def snapshot_read(spark, folder):
    """What two readers count in each month: one began before months were replaced, one after."""
    path = work_folder(spark, "snapshot_read")
    games = feed.games(spark, folder)
    snapshots.replace_months(spark, games, path, _months(spark, folder), tables.by_month)
    before = tables.read_bronze(spark, path)
    snapshots.replace_months(spark, _reloaded(games), path, REPLACED_MONTHS, tables.by_month)
    after = tables.read_bronze(spark, path)
    both = before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))
    return both.groupBy("reader", "date").agg(
        F.count("*").alias("games"), F.sum("game.metacritic").cast("bigint").alias("score_sum")
    )


def silver_write(spark, folder):
    path = work_folder(spark, "silver_write")
    tables.write_months(_silver(spark, folder), path, compact=True)
    return _flat_silver(tables.read_silver(spark, path))


def full_refresh(spark, folder):
    """A good build, then one whose checks fail; readers still get the good one."""
    layout = Layout(work_folder(spark, "full_refresh"))
    games, mapping = feed.games(spark, folder), feed.listed_mapping(spark, folder)
    for content in (_scored(games), games):
        tables.write_months(content, layout.bronze, compact=True)
        try:
            refresh.refresh(spark, layout, mapping, feed.ALL_BRANDS)
        except quality.QualityGateError:
            pass
    build = refresh.current_build(spark, layout)
    if build is None:
        return _flat_silver(spark.createDataFrame([], SILVER))
    return _flat_silver(tables.read_silver(spark, build.silver))


def json_page_sink(spark, folder):
    """What the text of the written pages holds: games, kept nulls, unescaped letters."""
    path = work_folder(spark, "json_page_sink")
    raw_pages.write_pages(_pages(feed.games(spark, folder)), path)
    text = spark.read.schema("value string, date string").text(path)
    return text.groupBy("date").agg(
        F.sum(F.regexp_count("value", F.lit('"released":'))).alias("games"),
        F.sum(F.regexp_count("value", F.lit('"metacritic":null'))).alias("null_scores"),
        F.sum(F.regexp_count("value", F.lit('"name":"Édition №'))).alias("accented_names"),
    )


def _spoiled_backfill(spark: SparkSession, folder: str) -> tuple[Layout, DataFrame]:
    """A load of months with pages, without any, and with a page that is malformed, an error or no text."""
    layout = Layout(work_folder(spark, "spoiled_backfill"))
    games = feed.games(spark, folder).filter(~F.col("date").isin(*MISSING_MONTHS))
    raw_pages.write_pages(_pages(games), layout.raw)
    for month, name in ((MALFORMED_MONTH, "results"), (ERROR_MONTH, "detail")):
        broken = games.filter(F.col("date") == month).select(F.col("game.name").alias(name), "date")
        broken.write.mode("append").partitionBy("date").json(layout.raw)
    if UNREADABLE_MONTH in raw_pages.raw_months(spark, layout.raw):
        # Not what its name says it is.
        path = f"{layout.raw}/date={UNREADABLE_MONTH}/page.json.gz"
        storage.write_text(spark, path, "no compressed page")
    form = raw_pages.PageFormat(file_pattern="*.json*")
    report = bronze.backfill(spark, layout.raw, layout.bronze, *feed.months_around(spark, folder), form)
    return layout, report


def backfill_report(spark, folder):
    """Months with pages, without any, and with a page that is malformed, an error or no text."""
    return _spoiled_backfill(spark, folder)[1]


def quarantined_files(spark, folder):
    """Of the same load, which months have files that do not fit or cannot be read, and the games in sound files."""
    layout, _ = _spoiled_backfill(spark, folder)
    outcomes = bronze.file_outcomes(spark, layout.bronze)
    return outcomes.groupBy(F.col("date").alias("month")).agg(
        F.max(F.col("status") == "bad").alias("has_bad"),
        F.max(F.col("status") == "unreadable").alias("has_unreadable"),
        F.sum(F.when(F.col("status") == "read", F.col("games")).otherwise(0)).alias("sound_games"),
    )


def documents_as_written(spark, folder):
    """Each game's own text in bronze: order of keys, blanks, long and odd numbers, a key that is there twice."""
    layout = Layout(work_folder(spark, "documents_as_written"))
    orders = feed.table(spark, folder, "orders")
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    game = F.concat(
        F.lit('{"odd": 81.50,  "released": "'), day, F.lit('", "again": 1, "id":'), key.cast("string"),
        F.lit(', "again": 1.0e3, "long": 12345678901234567890123456789012345678901234567890, "name": "\\u00c9 №"}'),
    )
    page = F.concat(F.lit('{"results": ['), game, F.lit("]}")).alias("value")
    lines = orders.select(page, F.date_format("o_orderdate", "yyyy-MM").alias("date"))
    lines.write.partitionBy("date").text(layout.raw)
    form = raw_pages.PageFormat(lines=True, file_pattern="*.txt")
    bronze.backfill(spark, layout.raw, layout.bronze, *feed.months_around(spark, folder), form)
    return tables.read_bronze(spark, layout.bronze).select(
        "date", F.col("game.id").alias("id"), F.col("game.name").alias("name"), "document"
    )


# Projections and expressions


def silver_games(spark, folder):
    return _flat_silver(_silver(spark, folder))


def struct_field_nullsafe(spark, folder):
    return _silver(spark, folder).select("game_id", "esrb_rating")


def cast_date(spark, folder):
    """Releases written in five ways that name a day."""
    iso, key = F.col("game.released"), F.col("game.id")
    day = iso.cast("date")
    released = (
        F.when(key % 5 == 0, iso)
        .when(key % 5 == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(key % 5 == 2, F.date_format(day, "yyyy-M-d"))
        .when(key % 5 == 3, F.concat(F.lit(" "), iso, F.lit(" ")))
        .otherwise(F.concat(iso, F.lit(" 10:11:12")))
    )
    written = F.col("game").withField("released", released)
    games = feed.games(spark, folder).withColumn("game", written)
    return ops.to_silver(games).select("game_id", "release_date")


def fractional_scores(spark, folder):
    """Scores with halves in the pages, landed, loaded and typed."""
    layout = Layout(work_folder(spark, "fractional_scores"))
    half = (F.col("game.metacritic") % 83) / 2
    games = feed.games(spark, folder).withColumn("game", F.col("game").withField("metacritic", half))
    raw_pages.write_pages(_pages(games), layout.raw)
    bronze.backfill(spark, layout.raw, layout.bronze, *feed.months_around(spark, folder))
    silver = ops.to_silver(tables.read_bronze(spark, layout.bronze))
    return silver.select("game_id", "metacritic_score")


def cast_int(spark, folder):
    orders = feed.table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("game_id"),
        F.col("o_custkey").cast("int").alias("from_whole"),
        to_int((F.col("o_custkey") % 203) / F.lit(2.0)).alias("from_half"),
        to_int(F.col("o_totalprice")).alias("from_price"),
    )


def nested_list_names(spark, folder):
    return _flat_silver(_silver(spark, folder)).select("game_id", "console_names")


def list_names(spark, folder):
    return _flat_silver(_silver(spark, folder)).select("game_id", "genre_names")


def conditional_value(spark, folder):
    return _silver(spark, folder).select(
        "game_id", marts.highly_rated_id().alias("highly_rated_id")
    )


def threshold_param(spark, folder):
    return marts.brand_mart(_by_console(spark, folder), threshold=50)


def percentage_of_month(spark, folder):
    """Share of highly rated games per month; NULL for a month without scored games."""
    silver = _silver(spark, folder)
    counts = silver.groupBy("date").agg(
        F.count(marts.highly_rated_id()).alias("high"),
        F.count("metacritic_score").alias("scored"),
    )
    return counts.select("date", percentage(F.col("high"), F.col("scored")).alias("share"))


def round_half(spark, folder):
    orders = feed.table(spark, folder, "orders")
    near_tie = ((F.col("o_orderkey") % 1000) * 10 + 5) / F.lit(1000.0)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        round2(near_tie).alias("rounded_tie"),
        round2(F.col("o_totalprice") / 7).alias("rounded_price"),
    )


def bar_label(spark, folder):
    mart = marts.console_mart(_by_console(spark, folder))
    label = count_label(F.col("number_of_highly_rated_games"), F.col("number_of_games"))
    return mart.select("console_name", label.alias("bar_label"))


def ordered_category(spark, folder):
    """Brands in a fixed order; the one outside it loses its name and comes last."""
    return dashboard.ordered_brands(agg_brands(spark, folder), feed.BRAND_ORDER)


def month_key_of_release(spark, folder):
    return _silver(spark, folder).select("game_id", month_key(F.col("release_date")).alias("month"))


def month_bounds_of_release(spark, folder):
    first, last = month_bounds(F.col("release_date"))
    return _silver(spark, folder).select(
        "game_id", first.alias("first_day"), last.alias("last_day")
    )


def month_calendar_of_releases(spark, folder):
    span = _silver(spark, folder).agg(
        F.min("release_date").alias("first"), F.max("release_date").alias("last")
    )
    return span.select(F.explode(months_between(F.col("first"), F.col("last"))).alias("month"))


# Generators and joins


def unnest_select(spark, folder):
    unnested = ops.unnest_results(_pages(feed.games(spark, folder)))
    return _flat(unnested).select("date", "id", "downloaded_micros")


def lateral_unnest(spark, folder):
    return ops.unnest_consoles(_silver(spark, folder), "game_id")


def games_by_console(spark, folder):
    return _by_console(spark, folder)


# Aggregations


def distinct_rows(spark, folder):
    return marts.distinct_games(_by_console(spark, folder))


def distinct_names(spark, folder):
    return quality.listed_consoles(_silver(spark, folder))


def agg_brands(spark, folder):
    return marts.brand_mart(_by_console(spark, folder))


def agg_brands_lines(spark, folder):
    """The brand mart with a listing for each order line."""
    mapping = feed.nation_mapping(spark, folder)
    return marts.brand_mart(ops.games_by_console(feed.line_listings(spark, folder), mapping))


def agg_consoles(spark, folder):
    return marts.console_mart(_by_console(spark, folder))


def _unique_game_sums(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sums_of_unique_games(_silver(spark, folder), feed.console_mapping(spark, folder))


def brands_of_unique_games(spark, folder):
    return marts.brand_mart_of(_unique_game_sums(spark, folder))


def consoles_of_unique_games(spark, folder):
    return marts.console_mart_of(_unique_game_sums(spark, folder))


# Data checks


def dq_not_null(spark, folder):
    return quality.null_rows(_silver(spark, folder), "metacritic_score").select(
        "game_id", "game_name"
    )


def dq_unique(spark, folder):
    return quality.repeated_values(_by_console(spark, folder), "game_id")


def dq_accepted_values(spark, folder):
    return quality.unexpected_values(_by_console(spark, folder), "brand", feed.BRAND_ORDER)


def dq_coverage(spark, folder):
    return quality.unseen_consoles(
        feed.console_mapping(spark, folder), _silver(spark, folder)
    )


def dq_summary(spark, folder):
    silver, mapping = _silver(spark, folder), feed.console_mapping(spark, folder)
    by_console = ops.games_by_console(silver, mapping)
    consoles = marts.console_mart(by_console)
    return quality.all_checks(
        quality.mapping_checks(mapping, feed.BRAND_ORDER),
        quality.game_checks(silver),
        quality.coverage_check(quality.unseen_in_mart(mapping, consoles)),
        quality.mart_checks(marts.brand_mart(by_console), consoles),
    )


# Marts and checks from what has changed


def _kept_marts(spark: SparkSession, folder: str, games: DataFrame) -> changes.KeptMarts:
    """Kept marts of all months, brought up to date after some of them were replaced."""
    root = work_folder(spark, "kept_marts")
    path = f"{root}/bronze"
    marts_kept = changes.KeptMarts(spark, path, f"{root}/kept", feed.console_mapping(spark, folder))
    snapshots.replace_months(spark, games, path, _months(spark, folder), tables.by_month)
    marts_kept.update()
    snapshots.replace_months(spark, _reloaded(games), path, REPLACED_MONTHS, tables.by_month)
    marts_kept.update()
    return marts_kept


def brands_by_change(spark, folder):
    return _kept_marts(spark, folder, feed.games(spark, folder)).brand_mart()


def consoles_by_change(spark, folder):
    return _kept_marts(spark, folder, feed.games(spark, folder)).console_mart()


def dq_unique_by_month(spark, folder):
    """Game ids in more than one month: every eleventh game is in two other months as well, one of them replaced."""
    games = feed.games(spark, folder)
    again = games.filter(F.col("game.id") % 11 == 0)
    for month in ("1996-01", REPLACED_MONTHS[2]):
        games = games.unionAll(again.withColumn("date", F.lit(month)))
    return _kept_marts(spark, folder, games).repeated_games()


# Composed jobs


def bronze_games(spark, folder):
    """Bronze from pages, with a field that only the games' own documents have."""
    layout = Layout(work_folder(spark, "bronze_games"))
    tag = F.concat(F.lit("tag "), F.col("game.id"))
    games = feed.games(spark, folder).withColumn("game", F.col("game").withField("tag", tag))
    raw_pages.write_pages(_pages(games), layout.raw)
    bronze.backfill(spark, layout.raw, layout.bronze, *feed.months_around(spark, folder))
    loaded = tables.read_bronze(spark, layout.bronze)
    return _flat(loaded, F.get_json_object("document", "$.tag").alias("tag"))


def land_and_load(spark, folder):
    """Every scored game, landed and loaded with what is written and read by default."""
    layout = Layout(work_folder(spark, "land_and_load"))
    months = _months(spark, folder)
    raw.land_months(spark, feed.games(spark, folder), layout.raw, months, feed.DOWNLOADED_AT)
    bronze.load_months(spark, layout.raw, layout.bronze, months)
    differing = bronze.lost_games(spark, layout.bronze, months)
    quality.gate(quality.count_check(differing, "reconciled", "bronze_games", "date"))
    return tables.read_bronze(spark, layout.bronze).select(
        "date", F.col("game.id").alias("id"), F.col("game.metacritic").cast("bigint").alias("metacritic")
    )


def brand_metrics(spark, folder):
    return dashboard.brand_metrics(agg_brands(spark, folder), feed.BRAND_ORDER)


def brand_chart(spark, folder):
    return dashboard.brand_chart(agg_brands(spark, folder), feed.BRAND_ORDER, feed.COLORS)


def console_chart(spark, folder):
    return dashboard.console_chart(agg_consoles(spark, folder), feed.COLORS)


def publish_by_table(spark, folder):
    """What readers get when a check of the console mart alone has failed: brands of this build, no consoles."""
    layout = Layout(work_folder(spark, "publish_by_table"))
    tables.write_months(_scored(feed.games(spark, folder)), layout.bronze, compact=True)

    def no_small_console(mart: DataFrame) -> DataFrame:
        return quality.count_check(mart, "none_expected", refresh.CONSOLE_MART, "console_name")

    try:
        mapping = feed.listed_mapping(spark, folder)
        refresh.refresh(spark, layout, mapping, feed.ALL_BRANDS, more_checks={refresh.CONSOLE_MART: no_small_console})
    except quality.QualityGateError:
        pass
    history = refresh.check_history(spark, layout).groupBy("table").agg(F.max(F.col("status") == "fail").alias("failed"))
    found = [name for name in refresh.TABLES if refresh.build_with(spark, layout, name)]
    return history.select("table", "failed", F.col("table").isin(*found).alias("published"))


def end_to_end_load(spark, folder):
    """What readers find after one run: the brand mart, or nothing if a check failed."""
    layout = Layout(work_folder(spark, "end_to_end_load"))
    months = _months(spark, folder)
    games = feed.games(spark, folder)
    raw.land_months(spark, games, layout.raw, months, feed.DOWNLOADED_AT)
    mapping = feed.listed_mapping(spark, folder)
    try:
        _, build, _ = end_to_end.run(spark, layout, months, mapping, feed.ALL_BRANDS)
    except quality.QualityGateError:
        return agg_brands(spark, folder).limit(0)
    return tables.read_mart(spark, build.gold, refresh.BRAND_MART)


QUERIES = {
    "json_page_scan": json_page_scan,
    "partition_column_scan": partition_column_scan,
    "bronze_scan": bronze_scan,
    "gold_scan": gold_scan,
    "seed_scan": seed_scan,
    "source_slice": source_slice,
    "ordered_slice": ordered_slice,
    "partitioned_write": partitioned_write,
    "partition_replace": partition_replace,
    "snapshot_read": snapshot_read,
    "silver_write": silver_write,
    "full_refresh": full_refresh,
    "json_page_sink": json_page_sink,
    "backfill_report": backfill_report,
    "quarantined_files": quarantined_files,
    "silver_games": silver_games,
    "struct_field_nullsafe": struct_field_nullsafe,
    "cast_date": cast_date,
    "cast_int": cast_int,
    "fractional_scores": fractional_scores,
    "nested_list_names": nested_list_names,
    "list_names": list_names,
    "conditional_value": conditional_value,
    "threshold_param": threshold_param,
    "percentage": percentage_of_month,
    "round_half": round_half,
    "bar_label": bar_label,
    "ordered_category": ordered_category,
    "month_key": month_key_of_release,
    "month_bounds": month_bounds_of_release,
    "month_calendar": month_calendar_of_releases,
    "unnest_select": unnest_select,
    "lateral_unnest": lateral_unnest,
    "games_by_console": games_by_console,
    "distinct_rows": distinct_rows,
    "distinct_names": distinct_names,
    "agg_brands": agg_brands,
    "agg_brands_lines": agg_brands_lines,
    "agg_consoles": agg_consoles,
    "brands_of_unique_games": brands_of_unique_games,
    "consoles_of_unique_games": consoles_of_unique_games,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_coverage": dq_coverage,
    "dq_summary": dq_summary,
    "brands_by_change": brands_by_change,
    "consoles_by_change": consoles_by_change,
    "dq_unique_by_month": dq_unique_by_month,
    "bronze_games": bronze_games,
    "documents_as_written": documents_as_written,
    "land_and_load": land_and_load,
    "brand_metrics": brand_metrics,
    "brand_chart": brand_chart,
    "console_chart": console_chart,
    "publish_by_table": publish_by_table,
    "end_to_end_load": end_to_end_load,
}
