"""Tables the dashboard draws: a row per brand or console of the published marts."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.functions import count_label, display_rank, known_category, value_lookup
from scorelake.plans.refresh import build_with
from scorelake.seeds import BRAND_COLORS, BRANDS
from scorelake.sources.layout import Layout
from scorelake.sources.tables import read_mart

#: Rows of a mart that is taken to the driver, at most: a mart has a row for each console or brand.
MOST_ROWS = 10_000


def load_mart(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A mart from the last build that it was published from."""
    build = build_with(spark, layout, name)
    if build is None:
        raise LookupError(f"nothing published under {layout.root}")
    return read_mart(spark, build.gold, name)


def local_mart(spark: SparkSession, layout: Layout, name: str, most_rows: int = MOST_ROWS):
    """A published mart as a pandas frame, for whoever draws it; a larger one raises instead of filling the driver."""
    frame = load_mart(spark, layout, name).limit(most_rows + 1).toPandas()
    if len(frame) > most_rows:
        raise ValueError(f"{name} has more than {most_rows} rows")
    return frame


def ordered_brands(brands: DataFrame, order: Sequence[str] = BRANDS) -> DataFrame:
    """Brands in display order; one outside the order loses its name and comes last."""
    return (
        brands.withColumn("display_order", display_rank(F.col("brand"), order))
        .withColumn("brand", known_category(F.col("brand"), order))
        .orderBy(F.asc_nulls_last("display_order"))
    )


def brand_metrics(
    brands: DataFrame, order: Sequence[str] = BRANDS, tiles: int = 3
) -> DataFrame:
    """Average score of the first ``tiles`` brands."""
    return ordered_brands(brands, order).limit(tiles).select(
        "brand", "avg_metacritic_score", "display_order"
    )


def brand_chart(
    brands: DataFrame,
    order: Sequence[str] = BRANDS,
    colors: Mapping[str, str] = BRAND_COLORS,
) -> DataFrame:
    """Bars: highly rated share per brand, with label and colour."""
    label = count_label(F.col("number_of_highly_rated_games"), F.col("number_of_games"))
    return ordered_brands(brands, order).select(
        "brand",
        "percentage_of_highly_rated_games",
        label.alias("bar_label"),
        value_lookup(F.col("brand"), colors).alias("color"),
        "display_order",
    )


def console_chart(
    consoles: DataFrame, colors: Mapping[str, str] = BRAND_COLORS
) -> DataFrame:
    """Points: highly rated count against share per console, sized by number of games."""
    return consoles.select(
        "console_name",
        "brand",
        "number_of_highly_rated_games",
        "percentage_of_highly_rated_games",
        "number_of_games",
        value_lookup(F.col("brand"), colors).alias("color"),
    )
