"""Building silver and gold from bronze, published only when every check passes."""

import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import datetime, timedelta, timezone
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.operators.games import to_silver
from scorelake.operators.marts import brand_mart_of, console_mart_of, sums_of_unique_games
from scorelake.operators.quality import (
    QualityGateError,
    coverage_check,
    game_checks,
    mapping_checks,
    mart_checks,
    unseen_in_mart,
)
from scorelake.seeds import BRANDS, HIGHLY_RATED_THRESHOLD
from scorelake.sources import storage
from scorelake.sources.layout import Build, Layout
from scorelake.sources.tables import (
    read_bronze,
    read_mart,
    read_silver,
    write_mart,
    write_months,
)

SILVER, BRAND_MART, CONSOLE_MART = "silver_games", "agg_brands", "agg_consoles"
#: What both marts are made from, a row for each console.
SUMS = "console_sums"
PUBLISHED = "version string, published_at timestamp, tables array<string>"
#: How a version tells when it was started, and the file that says a build is not written any more.
STARTED = "%Y%m%dT%H%M%S%f"
FINISHED = "_finished"


#: What each published table is made from; a check that fails stops its table and all that follow.
MADE_FROM = {
    "console_mapping": (),
    SILVER: (),
    BRAND_MART: (SILVER, "console_mapping"),
    CONSOLE_MART: (SILVER, "console_mapping"),
}
TABLES = (SILVER, BRAND_MART, CONSOLE_MART)


def standing(failed: Collection[str], made_from: Mapping[str, Sequence[str]] = MADE_FROM) -> list[str]:
    """The tables that no failed check is on, nor on anything they are made from."""

    def stands(table: str) -> bool:
        return table not in failed and all(map(stands, made_from[table]))

    return [table for table in made_from if stands(table)]


def refresh(
    spark: SparkSession,
    layout: Layout,
    mapping: DataFrame,
    brands: Sequence[str] = BRANDS,
    threshold: int = HIGHLY_RATED_THRESHOLD,
    more_checks: Mapping[str, Callable[[DataFrame], DataFrame]] = MappingProxyType({}),
) -> tuple[Build, list]:
    """Rebuild silver and gold in a new folder and publish it; returns it and its checks.

    A failing check stops what depends on it: its table and those made from it stay unpublished,
    readers keep the last good ones, and ``QualityGateError`` names the failures when the others
    are published. ``more_checks`` gives further checks by table, as summaries of its rows. All
    outcomes are kept, see ``check_history``.
    """
    version = f"{datetime.now(timezone.utc):{STARTED}}-{uuid.uuid4().hex[:8]}"
    outcomes = _recorded(spark, layout, version, mapping_checks(mapping, brands))
    _raise_failures(outcomes)
    build = layout.build(version)
    try:
        outcomes += _build(spark, layout, build, mapping, threshold, version, more_checks)
        good = standing({row["table"] for row in outcomes if row["status"] == "fail"})
        if published := [table for table in TABLES if table in good]:
            _publish(spark, layout, version, None if len(published) == len(TABLES) else published)
    finally:
        # Published or failed, nobody writes to it any more.
        if storage.exists(spark, build.root):
            storage.write_text(spark, f"{build.root}/{FINISHED}", version)
    _raise_failures(outcomes)
    return build, outcomes


def _build(
    spark: SparkSession,
    layout: Layout,
    build: Build,
    mapping: DataFrame,
    threshold: int,
    version: str,
    more_checks: Mapping[str, Callable[[DataFrame], DataFrame]],
) -> list:
    """Write silver and gold of a build; returns the outcomes of its checks. Marts of a bad silver raise."""
    # Bronze already lies by month, so rows go out again without a shuffle.
    write_months(to_silver(read_bronze(spark, layout.bronze)), build.silver)
    silver = read_silver(spark, build.silver)
    outcomes = _recorded(spark, layout, version, _with_more(game_checks(silver), SILVER, silver, more_checks))
    _raise_failures(outcomes)

    # Ids are unique and there by now, so neither mart has to bring games together.
    write_mart(sums_of_unique_games(silver, mapping, threshold), build.gold, SUMS)
    sums = read_mart(spark, build.gold, SUMS)
    write_mart(brand_mart_of(sums), build.gold, BRAND_MART)
    write_mart(console_mart_of(sums), build.gold, CONSOLE_MART)
    brands, consoles = (read_mart(spark, build.gold, name) for name in (BRAND_MART, CONSOLE_MART))
    # The finished mart tells which consoles are listed; silver is not scanned for that.
    summary = coverage_check(unseen_in_mart(mapping, consoles)).union(mart_checks(brands, consoles))
    for name, mart in ((BRAND_MART, brands), (CONSOLE_MART, consoles)):
        summary = _with_more(summary, name, mart, more_checks)
    return outcomes + _recorded(spark, layout, version, summary)


def _with_more(summary: DataFrame, name: str, table: DataFrame, more_checks) -> DataFrame:
    return summary.union(more_checks[name](table)) if name in more_checks else summary


def _recorded(spark: SparkSession, layout: Layout, version: str, summary: DataFrame) -> list:
    """Run checks, a handful of rows, and keep their outcomes."""
    rows = summary.collect()
    kept = spark.createDataFrame(rows, summary.schema).coalesce(1)
    kept = kept.select(F.lit(version).alias("version"), F.current_timestamp().alias("checked_at"), "*")
    kept.write.mode("append").parquet(layout.checks)
    return rows


def _raise_failures(outcomes: Sequence) -> None:
    if failed := [row for row in outcomes if row["status"] == "fail"]:
        raise QualityGateError(failed)


def check_history(spark: SparkSession, layout: Layout) -> DataFrame:
    """``(version, checked_at, check, table, column, failures, status)`` of all builds that were tried."""
    return spark.read.parquet(layout.checks)


def current_build(spark: SparkSession, layout: Layout) -> Build | None:
    """The build published last as a whole, None before the first."""
    versions = _published(spark, layout, 1)
    return layout.build(versions[0]) if versions else None


def build_with(spark: SparkSession, layout: Layout, table: str) -> Build | None:
    """The last build that ``table`` was published from, as a whole build or by itself."""
    versions = _published(spark, layout, 1, table)
    return layout.build(versions[0]) if versions else None


def drop_old_builds(
    spark: SparkSession, layout: Layout, keep: int = 2, given_up: timedelta = timedelta(days=7)
) -> list[str]:
    """Delete finished builds but the ``keep`` published last, failed builds included.

    A build that nobody has finished may still be written; it goes when its start lies
    ``given_up`` back. Before the first publication nothing is deleted.
    """
    kept = _published(spark, layout, keep)
    if kept:
        kept += [version for table in TABLES for version in _published(spark, layout, keep, table)]
    names = storage.child_names(spark, layout.builds) if kept else []
    limit = f"{datetime.now(timezone.utc) - given_up:{STARTED}}"
    old = [
        name
        for name in names
        if name not in kept
        and (name < limit or storage.exists(spark, f"{layout.builds}/{name}/{FINISHED}"))
    ]
    for name in old:
        storage.delete(spark, f"{layout.builds}/{name}")
    return old


def _publish(spark: SparkSession, layout: Layout, version: str, tables: Sequence[str] | None = None) -> None:
    # Appending one row is a single small commit on any store; nothing is renamed.
    row = spark.range(1).select(
        F.lit(version).alias("version"),
        F.current_timestamp().alias("published_at"),
        F.lit(None if tables is None else list(tables)).cast("array<string>").alias("tables"),
    )
    row.write.mode("append").parquet(layout.published)


def _published(spark: SparkSession, layout: Layout, most: int, table: str | None = None) -> list[str]:
    """The versions published last, the latest first; not when they were started counts."""
    if not storage.exists(spark, layout.published):
        return []
    versions = spark.read.schema(PUBLISHED).parquet(layout.published)
    # Without tables named it is the whole build.
    wanted = F.col("tables").isNull()
    if table is not None:
        wanted |= F.array_contains("tables", table)
    latest = versions.filter(wanted).orderBy(F.desc("published_at"), F.desc("version")).limit(most)
    return [row["version"] for row in latest.collect()]
