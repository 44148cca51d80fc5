"""From raw pages to typed games to one row per game and console."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorelake.functions import month_bounds, strict_date, to_int
from scorelake.operators.joins import join_dimension
from scorelake.seeds import SCORE_RANGE
from scorelake.sources.tables import read_in_order

#: Rows of a slice that a task sorts, about, and so few that another task is not worth it.
TASK_ROWS = 2_000_000
LEAST_ROWS = 10_000


def unnest_results(pages: DataFrame) -> DataFrame:
    """One row per game of each page, with its document; a page without games gives none."""
    if "documents" not in pages.columns:
        return pages.select("downloaded_at", F.explode("results").alias("game"), "date")
    both = F.explode(F.arrays_zip("results", "documents")).alias("both")
    return pages.select("downloaded_at", both, "date").select(
        "downloaded_at",
        F.col("both.results").alias("game"),
        F.col("both.documents").alias("document"),
        "date",
    )


def to_silver(bronze: DataFrame) -> DataFrame:
    """Typed, flat games. Text that is no date, or a score too large, raises.

    Lists are read by path, not with a lambda, so that a Parquet scan reads the one
    nested leaf needed. A NULL list stays NULL and an empty one empty.
    """
    score = F.col("game.metacritic")
    score_type = bronze.select(score).schema[0].dataType
    whole = isinstance(score_type, T.IntegralType)
    return bronze.select(
        "date",
        F.col("game.name").alias("game_name"),
        strict_date(F.col("game.released")).alias("release_date"),
        (score.cast("int") if whole else to_int(score)).alias("metacritic_score"),
        F.col("game.id").cast("string").alias("game_id"),
        F.col("game.platforms.platform.name").alias("console_names"),
        F.col("game.genres.name").alias("genre_names"),
        F.col("game.esrb_rating.name").alias("esrb_rating"),
    )


def source_slice(
    silver: DataFrame,
    first_month: str,
    last_month: str,
    score_range: tuple[int, int] = SCORE_RANGE,
) -> DataFrame:
    """Scored games released in the given months, by release; no score, no row.

    A game lies in the folder of the month of its release, so other folders are not read. Games are
    counted by day first, which reads two columns, and then dealt to tasks by ranges of days with
    about as many games. Where a single day is too much for a task, a range sort deals them out
    instead; the row number last in its order lets it spread copies of one game over tasks.
    """
    rows = silver.filter(in_slice(first_month, last_month, score_range))
    days = sorted(rows.groupBy("release_date").count().collect())  # one row for each day
    parts, part_of = _ranges([row["count"] for row in days], silver.sparkSession.sparkContext.defaultParallelism)
    if part_of is None:
        return rows.orderBy("release_date", "game_id", F.monotonically_increasing_id())
    first = days[0]["release_date"] if days else None
    place = [0] * (1 + (days[-1]["release_date"] - first).days if days else 1)
    for row, part in zip(days, part_of, strict=True):
        place[(row["release_date"] - first).days] = part
    at = F.datediff("release_date", F.lit(first).cast("date"))
    dealt = rows.repartitionById(parts, F.get(F.lit(place), at).cast("int"))
    return dealt.sortWithinPartitions("release_date", "game_id")


def _ranges(counts: list[int], tasks: int) -> tuple[int, list[int] | None]:
    """How many ranges of neighbouring days, and each day's; None when a day has far more than a range's share."""
    total = sum(counts)
    parts = max(1, min(max(tasks, -(-total // TASK_ROWS)), -(-total // LEAST_ROWS)))
    share = -(-total // parts)
    if counts and max(counts) > max(2 * share, LEAST_ROWS):
        return parts, None
    before, found = 0, []
    for count in counts:
        found.append(min(before // max(share, 1), parts - 1))
        before += count
    return parts, found


def stored_slice(
    spark: SparkSession,
    path: str,
    first_month: str,
    last_month: str,
    score_range: tuple[int, int] = SCORE_RANGE,
) -> DataFrame:
    """``source_slice`` of a silver table at ``path``, months following each other without a shuffle."""
    kept = in_slice(first_month, last_month, score_range)
    order = ["release_date", "game_id"]
    return read_in_order(spark, path, first_month, last_month, order, lambda rows: rows.filter(kept))


def in_slice(first_month: str, last_month: str, score_range: tuple[int, int] = SCORE_RANGE) -> Column:
    first, _ = month_bounds(F.lit(f"{first_month}-01").cast("date"))
    _, last = month_bounds(F.lit(f"{last_month}-01").cast("date"))
    return (
        F.col("date").between(first_month, last_month)
        & F.col("release_date").between(first, last)
        & F.col("metacritic_score").between(*score_range)
    )


def unnest_consoles(silver: DataFrame, *columns: str) -> DataFrame:
    """One row per listed console, repeats included; NULL and empty lists give none."""
    return silver.select(*columns, F.explode("console_names").alias("console_name"))


def games_by_console(silver: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per game and listed console that the mapping knows."""
    listed = unnest_consoles(silver, "game_id", "metacritic_score")
    return join_dimension(listed, mapping, "console_name", spread_by="game_id").select(
        "game_id", "metacritic_score", "console_name", "brand", "is_handheld"
    )
