"""Landing games of a source table as raw pages, any number of months in one job."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.functions import month_key, strict_date
from scorelake.plans.bronze import month_report, month_table
from scorelake.seeds import SCORE_RANGE
from scorelake.sources.pages import ONE_PER_LINE, PageFormat, paginate, write_pages


def land_months(
    spark: SparkSession,
    source: DataFrame,
    raw: str,
    months: Sequence[str],
    downloaded_at: datetime | None = None,
    form: PageFormat = ONE_PER_LINE,
    score_range: tuple[int, int] = SCORE_RANGE,
) -> DataFrame:
    """Make ``months`` of raw hold the scored games ``source`` has for them.

    ``source`` has a column ``game``; its release puts a game in a month. Returns
    ``(month, status)``; a month the source has nothing for ends up without pages.
    """
    months = sorted(set(months))
    released = strict_date(F.col("game.released"))
    scored = source.filter(F.col("game.metacritic").between(*score_range)).select(
        "game", month_key(released).alias("date")
    )
    pages = paginate(scored.filter(F.col("date").isin(*months)), downloaded_at)
    landed = write_pages(pages, raw, form, months)
    return month_report(*[month_table(spark, part) for part in (months, landed, [])])
