"""Conversions for data of outside origin: a bad value is null, never an error."""

from pyspark.sql import Column, functions as F


def finite(value: Column) -> Column:
    """NaN and Infinity are no readings: one of them would spoil every average."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def number(text: Column) -> Column:
    return finite(text.try_cast("double"))


def flag(text: Column) -> Column:
    return text.try_cast("boolean")


def instant(text: Column) -> Column:
    return F.try_to_timestamp(text)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))
