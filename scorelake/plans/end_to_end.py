"""The whole job: raw pages to bronze to checked silver and gold."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from scorelake.operators.quality import count_check, gate
from scorelake.plans.bronze import load_months, lost_games
from scorelake.plans.refresh import refresh
from scorelake.seeds import BRANDS, HIGHLY_RATED_THRESHOLD, console_mapping
from scorelake.sources.layout import Build, Layout
from scorelake.sources.pages import AS_RECORDED, PageFormat


def run(
    spark: SparkSession,
    layout: Layout,
    months: Sequence[str],
    mapping: DataFrame | None = None,
    brands: Sequence[str] = BRANDS,
    threshold: int = HIGHLY_RATED_THRESHOLD,
    form: PageFormat = AS_RECORDED,
) -> tuple[DataFrame, Build, list]:
    """Load ``months`` and refresh; returns the month report, the build and its checks.

    Nothing is built unless bronze holds as many games as the pages did, month by month.
    """
    report = load_months(spark, layout.raw, layout.bronze, months, form)
    differing = lost_games(spark, layout.bronze, months)
    gate(count_check(differing, "reconciled", "bronze_games", "date"))
    mapping = console_mapping(spark) if mapping is None else mapping
    build, checks = refresh(spark, layout, mapping, brands, threshold)
    return report, build, checks
