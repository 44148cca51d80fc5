"""The given order tables read as a games source.

An order is a game, a nation a console and a region a brand. Every field, lists
included, is worked out from the order's own row: no list gathers rows of other tables,
so no order, customer or date, however common, makes one task's share grow.

Consoles 23 and 24 are in the mapping but no game lists them; region ASIA is left out
of the mapping, so its consoles are listed but unknown.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED_CONSOLES = 23
GENRES = 7
# Lists are runs of these lengths at most, cut from a fixed round of entries.
MAX_PLATFORMS = 5
MAX_GENRES = 3
PLATFORM_ROUND = 69
BRAND_ORDER = ["EUROPE", "AMERICA", "AFRICA"]
ALL_BRANDS = ["AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"]
COLORS = {"EUROPE": "#003791", "AMERICA": "#107C10", "AFRICA": "#E60012"}
DOWNLOADED_AT = datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def games(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(downloaded_at, game, date)``, as bronze holds them."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    released = F.col("o_orderdate").cast("date").cast("string")
    rating = F.struct(
        F.lit(None).cast("bigint").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("string").alias("slug"),
    )
    game = F.struct(
        key.alias("id"),
        F.concat(F.lit("Édition №"), key).alias("name"),
        released.alias("released"),
        F.when(customer % 101 != 0, (customer % 101).cast("double")).alias("metacritic"),
        F.when(key % 53 != 0, _platforms(customer, key)).alias("platforms"),
        F.when(key % 59 != 0, _genres(key, customer)).alias("genres"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", rating).alias("esrb_rating"),
    )
    return table(spark, folder, "orders").select(
        F.lit(DOWNLOADED_AT).cast("timestamp").alias("downloaded_at"),
        game.alias("game"),
        F.substring(released, 1, 7).alias("date"),
    )


def console_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Nations outside ASIA as consoles, their region as brand."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        .filter("r_name <> 'ASIA'")
        .select(
            F.concat(F.lit("Console "), F.col("n_nationkey")).alias("console_name"),
            F.col("r_name").alias("brand"),
            (F.col("n_nationkey") % 2 == 0).alias("is_handheld"),
        )
    )


def listed_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """The mapping without the consoles no game lists, which the checks accept."""
    unlisted = [f"Console {key}" for key in range(LISTED_CONSOLES, 25)]
    return console_mapping(spark, folder).filter(~F.col("console_name").isin(*unlisted))


def line_listings(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines as silver games: each lists its order on the nation of its supplier.

    A listing for each line needs no list gathered from other rows.
    """
    read = {name: table(spark, folder, name) for name in ("lineitem", "orders", "supplier", "nation")}
    customer = F.col("o_custkey") % 101
    return (
        read["lineitem"]
        .join(read["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(read["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("game_id"),
            F.when(customer != 0, customer).cast("int").alias("metacritic_score"),
            F.array("n_name").alias("console_names"),
        )
    )


def nation_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Nations outside ASIA by their names."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        .filter("r_name <> 'ASIA'")
        .select(
            F.col("n_name").alias("console_name"),
            F.col("r_name").alias("brand"),
            (F.col("n_nationkey") % 2 == 0).alias("is_handheld"),
        )
    )


def months_around(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The month before the first order and the one after the last."""
    first = F.add_months(F.min("o_orderdate").cast("date"), -1)
    last = F.add_months(F.max("o_orderdate").cast("date"), 1)
    row = table(spark, folder, "orders").agg(
        F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM")
    ).first()
    return row[0] or "1970-01", row[1] or "1970-01"


def _run(entries: list[str], start: Column, wanted: Column) -> Column:
    # One SQL literal: building as many columns call by call takes far longer.
    fixed = F.expr(f"array({', '.join(entries)})")
    return F.slice(fixed, (start + 1).cast("int"), wanted.cast("int"))


def _entry(key: int, name: str) -> str:
    return f"named_struct('id', {key}L, 'name', '{name}', 'slug', CAST(NULL AS STRING))"


def _platforms(start: Column, wanted: Column) -> Column:
    """Up to five consoles in a row; the round repeats some and has gaps."""
    entries = []
    for place in range(PLATFORM_ROUND + MAX_PLATFORMS):
        console = place * 2 // 3 * 7 % LISTED_CONSOLES
        entry = f"named_struct('platform', {_entry(console, f'Console {console}')})"
        entries.append(entry if place % 13 != 6 else "NULL")
    return _run(entries, start % PLATFORM_ROUND, wanted % (MAX_PLATFORMS + 1))


def _genres(start: Column, wanted: Column) -> Column:
    genres = (place % GENRES for place in range(GENRES + MAX_GENRES))
    entries = [_entry(genre, f"Genre {genre}") for genre in genres]
    return _run(entries, start % GENRES, wanted % (MAX_GENRES + 1))
