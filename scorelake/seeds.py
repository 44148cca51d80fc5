"""Fixed values the results depend on, and the console mapping as a table."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from scorelake.schemas import MAPPING

# Console name, owning brand, handheld or not.
CONSOLE_MAPPING = [
    ("Xbox", "Microsoft", False),
    ("Xbox 360", "Microsoft", False),
    ("Xbox Series S/X", "Microsoft", False),
    ("Xbox One", "Microsoft", False),
    ("Nintendo Switch", "Nintendo", False),
    ("Wii U", "Nintendo", False),
    ("Nintendo DS", "Nintendo", True),
    ("GameCube", "Nintendo", False),
    ("Nintendo 3DS", "Nintendo", True),
    ("Wii", "Nintendo", False),
    ("Nintendo 64", "Nintendo", False),
    ("Game Boy Advance", "Nintendo", True),
    ("Game Boy Color", "Nintendo", True),
    ("PS Vita", "Sony", True),
    ("PlayStation 4", "Sony", False),
    ("PlayStation", "Sony", False),
    ("PlayStation 3", "Sony", False),
    ("PSP", "Sony", True),
    ("PlayStation 2", "Sony", False),
    ("PlayStation 5", "Sony", False),
]

# Brands accepted in the mapping, in display order.
BRANDS = ["Sony", "Microsoft", "Nintendo"]

# Display colour per brand.
BRAND_COLORS = {"Sony": "#003791", "Nintendo": "#E60012", "Microsoft": "#107C10"}

# Rating threshold, score range and page size of the source,
# and first and last month of the full history.
HIGHLY_RATED_THRESHOLD = 80
SCORE_RANGE = (1, 100)
PAGE_SIZE = 40
FIRST_MONTH = "1984-01"
LAST_MONTH = "2026-04"

# What a backfill reports when no month failed.
ALL_MONTHS_WROTE = "All months wrote successfully!"
ALL_MONTHS_FETCHED = "All months fetched successfully!"


def console_mapping(spark: SparkSession) -> DataFrame:
    """The built-in console dimension."""
    rows = [dict(zip(MAPPING.names, row)) for row in CONSOLE_MAPPING]
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(MAPPING)), MAPPING)
