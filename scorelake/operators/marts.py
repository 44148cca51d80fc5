"""Aggregate marts over games by console."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import percentage, round2
from scorelake.operators.joins import join_dimension
from scorelake.seeds import HIGHLY_RATED_THRESHOLD

CONSOLE_KEYS = ["brand", "console_name", "is_handheld"]


def highly_rated(threshold: int = HIGHLY_RATED_THRESHOLD) -> Column:
    return F.col("metacritic_score") >= threshold


def highly_rated_id(threshold: int = HIGHLY_RATED_THRESHOLD) -> Column:
    """The game id of a highly rated game, NULL for any other."""
    return F.when(highly_rated(threshold), F.col("game_id"))


def distinct_games(by_console: DataFrame) -> DataFrame:
    """A game once per brand and score, however many of the brand's consoles list it."""
    return by_console.select("game_id", "metacritic_score", "brand").distinct()


def with_share(mart: DataFrame) -> DataFrame:
    return mart.withColumn(
        "percentage_of_highly_rated_games",
        percentage(F.col("number_of_highly_rated_games"), F.col("number_of_games")),
    )


def brand_mart(by_console: DataFrame, threshold: int = HIGHLY_RATED_THRESHOLD) -> DataFrame:
    """Average score, game counts and highly rated share per brand.

    Rows shuffle once, on the evenly spread game, and each task first drops the repeats
    it sees; what then goes to the few brands are partial counts.
    """
    return with_share(
        distinct_games(by_console)
        .groupBy("brand")
        .agg(
            round2(F.avg("metacritic_score")).alias("avg_metacritic_score"),
            F.count("game_id").alias("number_of_games"),
            F.count(highly_rated_id(threshold)).alias("number_of_highly_rated_games"),
        )
    )


def console_mart(by_console: DataFrame, threshold: int = HIGHLY_RATED_THRESHOLD) -> DataFrame:
    """Average score over all listings, distinct game counts and share per console.

    Two distinct counts in one aggregate would double every row before the shuffle.
    Grouping by game first makes both of them plain counts.
    """
    per_game = by_console.groupBy(*CONSOLE_KEYS, "game_id").agg(
        F.sum("metacritic_score").alias("score_sum"),
        F.count("metacritic_score").alias("scores"),
        F.max(highly_rated(threshold)).alias("is_high"),
    )
    return with_share(
        per_game.groupBy(*CONSOLE_KEYS).agg(
            round2(F.try_divide(F.sum("score_sum"), F.sum("scores"))).alias(
                "avg_metacritic_score"
            ),
            F.count("game_id").alias("number_of_games"),
            F.count_if(F.col("is_high") & F.col("game_id").isNotNull()).alias(
                "number_of_highly_rated_games"
            ),
        )
    )


def sums_of_unique_games(silver: DataFrame, mapping: DataFrame, threshold: int = HIGHLY_RATED_THRESHOLD) -> DataFrame:
    """Per console what both marts are made from, for games whose ids are unique and not null.

    All listings of a game are then in its own row, so whether a listing is the game's first on its
    console, or on its brand, is seen from the list before it: games need not be shuffled or
    grouped. One scan, one explode and one exchange of a row for each console and task feed both
    marts. ``mapping`` is broadcast after it was measured, with the consoles of each brand.
    """
    brand = F.array_agg("console_name").alias("brand_consoles")
    of_brand = mapping.groupBy(F.col("brand").alias("_brand")).agg(brand)
    wide = mapping.join(of_brand, mapping["brand"].eqNullSafe(of_brand["_brand"])).drop("_brand")
    listed = silver.select(
        "game_id", "metacritic_score", "console_names", F.posexplode("console_names").alias("place", "console_name")
    )
    earlier = F.slice("console_names", F.lit(1), F.col("place"))
    rows = join_dimension(listed, wide, "console_name", spread_by="game_id").select(
        *CONSOLE_KEYS,
        F.col("metacritic_score").alias("score"),
        (F.array_position("console_names", F.col("console_name")) == F.col("place") + 1).alias("on_console"),
        (~F.coalesce(F.arrays_overlap(earlier, "brand_consoles"), F.lit(False))).alias("on_brand"),
        highly_rated(threshold).alias("is_high"),
    )
    return rows.groupBy(*CONSOLE_KEYS).agg(
        F.sum("score").alias("score_sum"),
        F.count("score").alias("scores"),
        F.count_if("on_console").alias("games"),
        F.count_if(F.col("on_console") & F.col("is_high")).alias("high"),
        F.sum(F.when(F.col("on_brand"), F.col("score"))).alias("brand_score_sum"),
        F.count(F.when(F.col("on_brand"), F.col("score"))).alias("brand_scores"),
        F.count_if("on_brand").alias("brand_games"),
        F.count_if(F.col("on_brand") & F.col("is_high")).alias("brand_high"),
    )


def console_mart_of(sums: DataFrame) -> DataFrame:
    """The console mart of ``sums_of_unique_games``."""
    return with_share(
        sums.select(
            *CONSOLE_KEYS,
            round2(F.try_divide("score_sum", "scores")).alias("avg_metacritic_score"),
            F.col("games").alias("number_of_games"),
            F.col("high").alias("number_of_highly_rated_games"),
        )
    )


def brand_mart_of(sums: DataFrame) -> DataFrame:
    """The brand mart of ``sums_of_unique_games``."""
    return with_share(
        sums.groupBy("brand").agg(
            round2(F.try_divide(F.sum("brand_score_sum"), F.sum("brand_scores"))).alias("avg_metacritic_score"),
            F.sum("brand_games").alias("number_of_games"),
            F.sum("brand_high").alias("number_of_highly_rated_games"),
        )
    )
