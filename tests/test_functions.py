import pytest
from pyspark.sql import functions as F

from scorelake.functions import (
    count_label,
    display_rank,
    known_category,
    month_bounds,
    month_calendar,
    month_key,
    months_between,
    percentage,
    round2,
    to_int,
    value_lookup,
)
from scorelake.seeds import BRAND_COLORS, BRANDS, FIRST_MONTH, LAST_MONTH


def one(spark, **columns):
    return spark.range(1).select(*[value.alias(name) for name, value in columns.items()]).first()


def day(text):
    return F.lit(text).cast("date")


def test_round2_rounds_the_scaled_binary_value(spark):
    values = [(1.005, 1.0), (0.145, 0.14), (2.675, 2.68), (33.335, 33.34), (-1.115, -1.12)]
    for value, expected in values:
        assert one(spark, x=round2(F.lit(value))).x == expected
    assert one(spark, x=round2(F.lit(None).cast("double"))).x is None


def test_percentage(spark):
    assert one(spark, x=percentage(F.lit(1), F.lit(3))).x == 33.33
    assert one(spark, x=percentage(F.lit(0), F.lit(0))).x is None
    assert dict(spark.range(1).select(percentage(F.lit(1), F.lit(3)).alias("x")).dtypes) == {
        "x": "double"
    }


def test_to_int(spark):
    for value, expected in [(80.5, 80), (81.5, 82), (80.51, 81), (-0.5, 0)]:
        assert one(spark, x=to_int(F.lit(value))).x == expected
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        one(spark, x=to_int(F.lit(3e9)))


def test_months(spark):
    first, last = month_bounds(day("2024-02-17"))
    row = one(spark, key=month_key(day("2024-02-17")), first=first, last=last)
    assert (row.key, str(row["first"]), str(row["last"])) == ("2024-02", "2024-02-01", "2024-02-29")
    assert str(one(spark, x=month_bounds(day("2023-02-01"))[1]).x) == "2023-02-28"


def test_month_steps_from_the_31st_skip_none(spark):
    row = one(spark, months=months_between(day("2024-01-31"), day("2024-04-30")))
    assert row.months == ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_full_history(spark):
    months = [row.month for row in month_calendar(spark, FIRST_MONTH, LAST_MONTH).collect()]
    assert len(months) == len(set(months)) == 508
    assert (min(months), max(months)) == ("1984-01", "2026-04")


def test_display(spark):
    for brand, rank, known, color in [
        ("Sony", 1, "Sony", "#003791"),
        ("Nintendo", 3, "Nintendo", "#E60012"),
        ("Sega", None, None, None),
        (None, None, None, None),
    ]:
        column = F.lit(brand).cast("string")
        row = one(
            spark,
            rank=display_rank(column, BRANDS),
            known=known_category(column, BRANDS),
            color=value_lookup(column, BRAND_COLORS),
        )
        assert (row.rank, row.known, row.color) == (rank, known, color)


def test_count_label(spark):
    assert one(spark, x=count_label(F.lit(12), F.lit(40))).x == "12 out of 40"
    assert one(spark, x=count_label(F.lit(None).cast("int"), F.lit(40))).x is None
