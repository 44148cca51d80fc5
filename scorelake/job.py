"""Command line for the jobs over one lake.

    python -m scorelake.job run --root s3a://lake --first 2022-01 --last 2022-03
    python -m scorelake.job backfill --root s3a://lake
    python -m scorelake.job land --root s3a://lake --source s3a://source/games
    python -m scorelake.job refresh --root s3a://lake --mapping s3a://lake/mapping.csv
    python -m scorelake.job update --root s3a://lake --mapping s3a://lake/mapping.csv
    python -m scorelake.job audit --root s3a://lake --first 2022-01 --last 2022-03
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from scorelake.functions import month_calendar
from scorelake.plans import bronze, changes, raw, refresh
from scorelake.seeds import (
    ALL_MONTHS_FETCHED,
    BRANDS,
    FIRST_MONTH,
    HIGHLY_RATED_THRESHOLD,
    LAST_MONTH,
    console_mapping,
)
from scorelake.sources.layout import Layout
from scorelake.sources.pages import PageFormat, raw_months
from scorelake.sources.tables import read_mapping


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="scorelake.job")
    parser.add_argument("job", choices=["audit", "backfill", "land", "refresh", "run", "update"])
    parser.add_argument("--root", required=True, help="folder or bucket of the lake")
    parser.add_argument("--first", default=FIRST_MONTH, help="first month, YYYY-MM")
    parser.add_argument("--last", default=LAST_MONTH, help="last month, YYYY-MM")
    parser.add_argument(
        "--lines", action="store_true", default=None, help="raw files hold a page per line, else as recorded"
    )
    parser.add_argument("--files", default="*.json", help="pattern of raw files that are pages")
    parser.add_argument("--source", help="Parquet table with a column game, to land from")
    parser.add_argument("--mapping", help="CSV with the console mapping, else the built-in one")
    parser.add_argument("--brands", nargs="+", default=BRANDS, help="brands the mapping may have")
    parser.add_argument("--threshold", type=int, default=HIGHLY_RATED_THRESHOLD)
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parse(arguments)
    spark = spark or SparkSession.builder.appName("scorelake").getOrCreate()
    layout = Layout(options.root.rstrip("/"))
    form = PageFormat(lines=options.lines, file_pattern=options.files)
    if options.job == "land":
        land(spark, layout, options)
        return
    if options.job == "audit":
        audit(spark, layout, options, form)
        return
    mapping = read_mapping(spark, options.mapping) if options.mapping else console_mapping(spark)
    if options.job == "update":
        kept = changes.KeptMarts(spark, layout.bronze, layout.kept, mapping, options.threshold)
        print(f"changed: {', '.join(kept.update()) or 'nothing'}")
        return
    if options.job != "refresh":
        outside = bronze.months_outside(spark, layout.raw, options.first, options.last)
        if outside:
            print(f"not read, outside {options.first} to {options.last}: {', '.join(outside)}")
        report = bronze.backfill(
            spark, layout.raw, layout.bronze, options.first, options.last, form
        )
        bronze.write_failed_months(report, layout.failed_months)
    if options.job != "backfill":
        refresh.refresh(spark, layout, mapping, options.brands, options.threshold)
        refresh.drop_old_builds(spark, layout)


def audit(spark: SparkSession, layout: Layout, options: argparse.Namespace, form: PageFormat) -> None:
    """Print the months of which raw, as it is now, and bronze do not hold as many games."""
    months = [m for m in raw_months(spark, layout.raw) if options.first <= m <= options.last]
    report = bronze.month_table(spark, months).selectExpr("month", "'loaded' AS status")
    for row in bronze.unreconciled(spark, layout.raw, layout.bronze, report, form).orderBy("month").collect():
        print(f"{row['month']}: {row['games']} games in raw, {row['loaded']} in bronze")


def land(spark: SparkSession, layout: Layout, options: argparse.Namespace) -> None:
    """Land the source's months as pages and write which of them failed."""
    calendar = month_calendar(spark, options.first, options.last).collect()
    months = [row["month"] for row in calendar]
    report = raw.land_months(spark, spark.read.parquet(options.source), layout.raw, months)
    bronze.write_failed_months(report, layout.failed_landings, ALL_MONTHS_FETCHED)


if __name__ == "__main__":
    main()
