"""Loading raw pages into the bronze table, any number of months in one job."""

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.functions import month_calendar
from scorelake.seeds import ALL_MONTHS_WROTE, FIRST_MONTH, LAST_MONTH
from scorelake.sources import snapshots, storage
from scorelake.sources.pages import (
    AS_RECORDED,
    CORRUPT,
    PageFormat,
    game_counts,
    marked_pages,
    page_folders,
    raw_files,
    raw_months,
    read_game,
    scan_pages,
)
from scorelake.sources.tables import by_month, read_bronze

#: The part of a version that has what its pages hold besides games, and where files' outcomes lie.
PAGES, OUTCOMES = "pages", "_outcomes"
PAGE_ROWS = "file string, date string, games bigint, complaint string, document string"
OUTCOME = "file string, date string, length bigint, pages bigint, games bigint, status string, version string"


def load_months(
    spark: SparkSession,
    raw: str,
    bronze: str,
    months: Sequence[str],
    form: PageFormat = AS_RECORDED,
) -> DataFrame:
    """Replace ``months`` of bronze with what raw holds; returns ``(month, status)``.

    All months load in a single job that decodes each game once. A month with a file that cannot
    be read, or a page or game that does not fit, keeps the rows it had, and so does one whose
    pages are in another form than asked for; ``file_outcomes`` and ``quarantined`` tell which
    they are. The other months are put in place together, in one commit.
    """
    months = sorted(set(months))
    if not storage.exists(spark, raw):
        raise FileNotFoundError(f"PATH_NOT_FOUND: {raw}")
    folders, mismatched = page_folders(spark, raw, months, form)
    version = snapshots.new_version()
    landed = snapshots.write(by_month(_entries(scan_pages(spark, raw, folders, form), form)), bronze, version)
    _write_outcomes(spark, raw, bronze, version, folders, form)
    failed = set(mismatched)
    outcomes = file_outcomes(spark, bronze, version).filter("status <> 'read'")
    failed |= {row["date"] for row in outcomes.select("date").distinct().collect()}  # months
    sound = [month for month in months if month not in failed]
    snapshots.place(spark, bronze, version, sound, landed)
    loaded = [month for month in sound if month in landed]
    return month_report(*[month_table(spark, part) for part in (months, loaded, failed)])


def _entries(pages: DataFrame, form: PageFormat) -> DataFrame:
    """Bronze rows as the part ``rows``; as the part ``pages`` a row for each page, and for each game that does not fit."""
    whole = F.col(CORRUPT).isNull() & F.col("results").isNotNull()
    games = F.transform(
        F.when(whole, F.col("results")).otherwise(F.array().cast("array<string>")),
        lambda text: F.struct(text.alias("document"), F.lit(True).alias("is_game")),
    )
    page = F.array(F.struct(F.lit(None).cast("string").alias("document"), F.lit(False).alias("is_game")))
    each = pages.select(
        "downloaded_at",
        "file",
        "date",
        F.when(whole, F.size("results")).otherwise(0).alias("games"),
        F.when(~whole, "page").alias("complaint"),
        F.explode(F.concat(page, games)).alias("entry"),
    ).select("*", "entry.*")
    read = each.withColumn("read", read_game(F.col("document"), form))
    fits = F.col("is_game") & F.col("read").isNotNull() & F.col(f"read.{CORRUPT}").isNull()
    fits = F.coalesce(fits, F.lit(False))
    page_only = ~F.col("is_game")
    return read.select(
        "downloaded_at",
        F.when(fits, F.col("read").dropFields(CORRUPT)).alias("game"),
        "document",
        F.when(~fits, F.col("file")).alias("file"),
        F.when(page_only, F.col("games")).cast("bigint").alias("games"),
        F.when(page_only, F.col("complaint")).when(~fits, "game").alias("complaint"),
        F.when(fits, snapshots.ROWS).otherwise(PAGES).alias("part"),
        "date",
    )


def _page_rows(spark: SparkSession, bronze: str, version: str) -> DataFrame:
    folder = f"{snapshots.version_folder(bronze, version)}/part={PAGES}"
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], PAGE_ROWS)
    return spark.read.schema(PAGE_ROWS).parquet(folder)


def _write_outcomes(spark, raw, bronze, version, folders, form) -> None:
    """How each file fared: read, bad (a page or game does not fit) or unreadable."""
    seen = _page_rows(spark, bronze, version).groupBy("file").agg(
        F.count("games").alias("pages"),
        F.sum("games").alias("games"),
        (F.count("complaint") > 0).alias("bad"),
    )
    zero = F.lit(0).cast("bigint")
    # A file of one page that has bytes but gives no page could not be read.
    lost = ~F.col("read") | (F.col("pages").isNull() & ~F.col("lines") & (F.col("length") > 0))
    status = F.when(lost, "unreadable").when(F.col("bad"), "bad").otherwise("read")
    outcomes = raw_files(spark, raw, folders, form).join(seen, "file", "left").select(
        "file",
        "date",
        "length",
        F.coalesce("pages", zero).alias("pages"),
        F.coalesce("games", zero).alias("games"),
        status.alias("status"),
    )
    outcomes.hint("rebalance").write.parquet(f"{bronze}/{OUTCOMES}/version={version}")


def file_outcomes(spark: SparkSession, bronze: str, version: str | None = None) -> DataFrame:
    """``(file, date, length, pages, games, status, version)`` of a load's raw files, or of all loads'."""
    folder = f"{bronze}/{OUTCOMES}" if version is None else f"{bronze}/{OUTCOMES}/version={version}"
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], OUTCOME)
    return spark.read.schema(OUTCOME).option("basePath", f"{bronze}/{OUTCOMES}").parquet(folder)


def quarantined(spark: SparkSession, bronze: str, version: str) -> DataFrame:
    """``(file, date, complaint, document)`` of a load's pages and games that do not fit, games with their text."""
    complaints = _page_rows(spark, bronze, version).filter("complaint IS NOT NULL")
    return complaints.select("file", "date", "complaint", "document")


def backfill(
    spark: SparkSession,
    raw: str,
    bronze: str,
    first_month: str = FIRST_MONTH,
    last_month: str = LAST_MONTH,
    form: PageFormat = AS_RECORDED,
) -> DataFrame:
    """``load_months`` over every month from ``first_month`` to ``last_month``."""
    calendar = month_calendar(spark, first_month, last_month).collect()
    return load_months(spark, raw, bronze, [row["month"] for row in calendar], form)


def months_outside(spark: SparkSession, raw: str, first_month: str, last_month: str) -> list[str]:
    """Raw months that a backfill from ``first_month`` to ``last_month`` does not read."""
    return [m for m in raw_months(spark, raw) if not first_month <= m <= last_month]


def lost_games(spark: SparkSession, bronze: str, months: Sequence[str] | None = None) -> DataFrame:
    """Months of which bronze does not hold as many games as their load has found in the pages.

    Nothing is decoded again: the load has counted each page's games, and rows are counted by
    the Parquet footers.
    """
    placed = {
        month: version
        for month, version in snapshots.current(spark, bronze).items()
        if version and (months is None or month in months)
    }
    versions = spark.createDataFrame(sorted(placed.items()), "month string, version string")
    found = file_outcomes(spark, bronze).groupBy(F.col("date").alias("month"), "version").agg(F.sum("games").alias("games"))
    rows = read_bronze(spark, bronze).groupBy(F.col("date").alias("month")).agg(F.count("*").alias("loaded"))
    # A row for each month.
    both = F.broadcast(versions).join(found, ["month", "version"], "left").join(rows, "month", "left")
    both = both.select("month", *(F.coalesce(name, F.lit(0)).alias(name) for name in ("games", "loaded")))
    return both.filter("games <> loaded")


def unreconciled(
    spark: SparkSession, raw: str, bronze: str, report: DataFrame, form: PageFormat = AS_RECORDED
) -> DataFrame:
    """Loaded or empty months of which raw, as it is now, and bronze do not hold as many games.

    This reads the pages again; ``lost_games`` compares with what the load has read.
    """
    done = report.filter("status <> 'failed'").select("month")
    months = [row["month"] for row in done.collect()]  # the report's, one row for each month
    landed = game_counts(marked_pages(spark, raw, months, form))
    try:
        rows = read_bronze(spark, bronze)
    except AnalysisException:
        rows = None  # no month has ever had a game
    loaded = (
        done.select("month", F.lit(0).cast("bigint").alias("loaded"))
        if rows is None
        else rows.groupBy(F.col("date").alias("month")).agg(F.count("*").alias("loaded"))
    )
    both = done.join(landed, "month", "left").join(loaded, "month", "left")
    both = both.select("month", *(F.coalesce(name, F.lit(0)).alias(name) for name in ("games", "loaded")))
    return both.filter("games <> loaded")


def month_report(calendar: DataFrame, loaded: DataFrame, failed: DataFrame) -> DataFrame:
    """Every calendar month as ``loaded``, ``failed`` or, with nothing landed, ``empty``."""
    outcomes = loaded.select("month", F.lit("loaded").alias("outcome")).union(
        failed.select("month", F.lit("failed").alias("outcome"))
    )
    return calendar.join(outcomes, "month", "left").select(
        "month", F.coalesce("outcome", F.lit("empty")).alias("status")
    )


def failed_months_text(report: DataFrame, all_well: str = ALL_MONTHS_WROTE) -> DataFrame:
    """The failed months in order, one per line, or the one line ``all_well``."""
    failed = report.filter("status = 'failed'").agg(
        F.array_sort(F.collect_list("month")).alias("months")
    )
    lines = F.when(F.size("months") > 0, F.col("months")).otherwise(F.array(F.lit(all_well)))
    return failed.select(F.explode(lines).alias("value"))


def write_failed_months(
    report: DataFrame, path: str, all_well: str = ALL_MONTHS_WROTE
) -> None:
    failed_months_text(report, all_well).write.mode("overwrite").text(path)


def month_table(spark: SparkSession, months: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(month,) for month in sorted(months)], "month string")
