"""Data checks: the failing rows of each, and their counts as a summary."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.operators.games import unnest_consoles


class QualityGateError(Exception):
    """Raised when a check that others depend on fails; holds the failing summary rows."""

    def __init__(self, failed: list):
        self.failed = failed
        listed = ", ".join(
            f"{row['check']} {row['table']}.{row['column']}: {row['failures']}" for row in failed
        )
        super().__init__(f"checks failed: {listed}")


def null_rows(table: DataFrame, column: str) -> DataFrame:
    return table.filter(F.col(column).isNull())


def repeated_values(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("records"))
        .filter("records > 1")
    )


def unexpected_values(table: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside ``accepted``; NULL passes."""
    return (
        table.filter(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("records"))
    )


def listed_consoles(silver: DataFrame) -> DataFrame:
    """Every console name any game lists, once."""
    return unnest_consoles(silver).distinct()


def unseen_consoles(mapping: DataFrame, silver: DataFrame) -> DataFrame:
    """Consoles of the mapping that no game lists."""
    return mapping.select("console_name").join(
        listed_consoles(silver), "console_name", "left_anti"
    )


def unseen_in_mart(mapping: DataFrame, consoles: DataFrame) -> DataFrame:
    """``unseen_consoles`` from the console mart, which has each listed console of the mapping."""
    return mapping.select("console_name").join(consoles, "console_name", "left_anti")


def key_checks(
    table: DataFrame, name: str, key: str, required: Sequence[str] = ()
) -> DataFrame:
    """``not_null`` and ``unique`` of ``key`` and ``not_null`` of ``required``, in one pass."""
    per_value = table.groupBy(key).agg(
        F.count("*").alias("records"),
        *[F.count_if(F.col(column).isNull()).alias(f"null_{column}") for column in required],
    )
    checks = [
        ("not_null", key, F.sum(F.when(F.col(key).isNull(), F.col("records")))),
        ("unique", key, F.count_if(F.col(key).isNotNull() & (F.col("records") > 1))),
        *[("not_null", column, F.sum(f"null_{column}")) for column in required],
    ]
    counts = per_value.agg(
        F.array(
            *[_summary(check, name, column, failures) for check, column, failures in checks]
        ).alias("checks")
    )
    return counts.select(F.inline("checks"))


def count_check(failing: DataFrame, check: str, name: str, column: str) -> DataFrame:
    """Summary row of a check from its failing rows."""
    counted = failing.agg(F.array(_summary(check, name, column, F.count("*"))).alias("checks"))
    return counted.select(F.inline("checks"))


def _summary(check: str, name: str, column: str, failures: Column) -> Column:
    found = F.coalesce(failures, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(name).alias("table"),
        F.lit(column).alias("column"),
        found.alias("failures"),
        F.when(found > 0, "fail").otherwise("pass").alias("status"),
    )


def mapping_checks(mapping: DataFrame, brands: Sequence[str]) -> DataFrame:
    return key_checks(mapping, "console_mapping", "console_name", ["brand"]).union(
        count_check(
            unexpected_values(mapping, "brand", brands),
            "accepted_values",
            "console_mapping",
            "brand",
        )
    )


def game_checks(silver: DataFrame) -> DataFrame:
    return key_checks(silver, "silver_games", "game_id", ["metacritic_score"])


def coverage_check(unseen: DataFrame) -> DataFrame:
    return count_check(unseen, "coverage", "console_mapping", "console_name")


def silver_checks(silver: DataFrame, mapping: DataFrame) -> DataFrame:
    return game_checks(silver).union(coverage_check(unseen_consoles(mapping, silver)))


def mart_checks(brands: DataFrame, consoles: DataFrame) -> DataFrame:
    return key_checks(brands, "agg_brands", "brand").union(
        key_checks(consoles, "agg_consoles", "console_name")
    )


def all_checks(*summaries: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, summaries)


def gate(summary: DataFrame) -> list:
    """Run the checks and return their rows, a handful; raise when any fails."""
    rows = summary.collect()
    failed = [row for row in rows if row["status"] == "fail"]
    if failed:
        raise QualityGateError(failed)
    return rows
