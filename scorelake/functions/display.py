"""Expressions behind the dashboard's labels, order and colours."""

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_label(part: Column, whole: Column) -> Column:
    """For example ``12 out of 40``; NULL when either count is."""
    return F.concat(part.cast("string"), F.lit(" out of "), whole.cast("string"))


def display_rank(value: Column, order: Sequence[str]) -> Column:
    """Position of ``value`` in ``order`` from 1; NULL for a value outside it."""
    ranks = F.array(*[F.lit(entry) for entry in order])
    return F.nullif(F.array_position(ranks, value), F.lit(0)).cast("int")


def known_category(value: Column, order: Sequence[str]) -> Column:
    """``value`` when ``order`` has it, else NULL."""
    return F.when(value.isin(*order), value)


def value_lookup(key: Column, values: Mapping[str, str]) -> Column:
    """The entry of a small fixed mapping; NULL for a key it lacks."""
    pairs = F.create_map(*[F.lit(part) for part in chain.from_iterable(values.items())])
    return pairs[key]
