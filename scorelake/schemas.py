"""Fixed schemas of every layer.

The raw pages carry no schema of their own, and what one month's pages happen to
hold (empty lists, ratings that are all null) says nothing about the next. Reading
with one declared struct keeps every month's files compatible.
"""

from pyspark.sql import types as T

PLATFORM_ENTRY = T.StructType(
    [
        T.StructField(
            "platform",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("slug", T.StringType()),
                ]
            ),
        )
    ]
)

LABEL = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("slug", T.StringType()),
    ]
)

# `released` stays text until the typed layer parses it strictly, and a score a fraction
# until that layer rounds it.
GAME = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("released", T.StringType()),
        T.StructField("metacritic", T.DoubleType()),
        T.StructField("platforms", T.ArrayType(PLATFORM_ENTRY)),
        T.StructField("genres", T.ArrayType(LABEL)),
        T.StructField("esrb_rating", LABEL),
    ]
)

# `documents` has the JSON text of each game with all its fields, whatever the schema names.
# `date` is the YYYY-MM month; it lives in the folder name, not in the files.
PAGE = T.StructType(
    [
        T.StructField("downloaded_at", T.TimestampType()),
        T.StructField("results", T.ArrayType(GAME)),
        T.StructField("documents", T.ArrayType(T.StringType())),
        T.StructField("date", T.StringType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("downloaded_at", T.TimestampType()),
        T.StructField("game", GAME),
        T.StructField("document", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("game_name", T.StringType()),
        T.StructField("release_date", T.DateType()),
        T.StructField("metacritic_score", T.IntegerType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("console_names", T.ArrayType(T.StringType())),
        T.StructField("genre_names", T.ArrayType(T.StringType())),
        T.StructField("esrb_rating", T.StringType()),
    ]
)

MAPPING = T.StructType(
    [
        T.StructField("console_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("is_handheld", T.BooleanType()),
    ]
)
