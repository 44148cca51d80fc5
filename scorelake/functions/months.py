"""Dates and month arithmetic; a month is its YYYY-MM key."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Year, month and day with one kind of separator, perhaps a time of day, and white space around.
DATE_FORM = r"^\s*0*(\d{1,4})([-/\\ ])(\d{1,2})\2(\d{1,2})(?:[ T]\d{1,2}:\d{1,2}.*)?\s*$"


def strict_date(text: Column) -> Column:
    """The date that a text with year, month and day names; any other text raises, NULL stays NULL.

    A cast is several times faster than parsing with a pattern, but also takes 2022-02. So
    text that is just what its date prints as is cast, and only other text is looked at:
    2022-2-3, 2022/02/03 and a date with a time of day are dates too.
    """
    day = text.try_cast("date")
    part = [F.regexp_extract(text, DATE_FORM, group).cast("int") for group in (1, 3, 4)]
    complaint = F.raise_error(F.concat(F.lit("not a date with year, month and day: "), text))
    return (
        F.when(day.cast("string") == text, day)
        .when(text.rlike(DATE_FORM), F.coalesce(F.make_date(*part), complaint.cast("date")))
        .when(text.isNotNull(), complaint.cast("date"))
    )


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_bounds(day: Column) -> tuple[Column, Column]:
    """First and last day of the month ``day`` falls in."""
    return F.trunc(day, "MM"), F.last_day(day)


def months_between(first: Column, last: Column) -> Column:
    """Every month key from ``first`` to ``last``, both included, as an array.

    Stepping from the first of the month keeps short months in.
    """
    days = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))
    return F.transform(days, month_key)


def month_calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per month from ``first`` to ``last`` (YYYY-MM), both included."""
    start, end = (F.to_date(F.lit(f"{month}-01"), "yyyy-MM-dd") for month in (first, last))
    return spark.range(1).select(F.explode(months_between(start, end)).alias("month"))
