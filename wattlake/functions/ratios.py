"""Ratios of the mix."""

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from wattlake.functions.lenient import zero_if_null
from wattlake.vocabulary import FOSSIL_SOURCES, GOLD_SOURCES


def ratio_fields() -> dict[str, Column]:
    """A consumption of -1 gives a null ratio."""
    return {
        "renewable_ratio": F.col("renewable_percentage") / 100,
        "fossil_ratio": (100 - F.col("fossil_free_percentage")) / 100,
        "production_consumption_ratio": F.try_divide(
            F.col("total_production"), F.col("total_consumption") + 1
        ),
    }


def total_of(columns: list[str]) -> Column:
    return reduce(add, [zero_if_null(F.col(c)) for c in columns])


def fossil_output() -> Column:
    return total_of(FOSSIL_SOURCES)


def all_output() -> Column:
    return total_of(GOLD_SOURCES)
