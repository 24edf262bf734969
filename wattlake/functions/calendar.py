"""Calendar fields of a timestamp column."""

from pyspark.sql import Column, functions as F

from wattlake.vocabulary import PEAK_HOURS, SUNDAY_FIRST_WEEKEND_DAYS, WEEKEND_DAYS


def calendar_fields(ts: Column) -> dict[str, Column]:
    """Monday is day 0."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "is_weekend": F.weekday(ts).isin(WEEKEND_DAYS).cast("int"),
        "is_peak_hour": F.hour(ts).isin(PEAK_HOURS).cast("int"),
    }


def sunday_first_fields(ts: Column) -> dict[str, Column]:
    """Sunday is day 1."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "month": F.month(ts),
        "is_weekend": F.dayofweek(ts).isin(SUNDAY_FIRST_WEEKEND_DAYS).cast("int"),
    }


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 with the fraction."""
    return F.unix_micros(ts) / F.lit(1e6)


def start_of_yesterday(as_of: Column) -> Column:
    return F.date_trunc("day", as_of) - F.expr("INTERVAL 1 DAY")


def tomorrow_at(as_of: Column, hour: int) -> Column:
    return F.date_trunc("day", as_of) + F.expr(f"INTERVAL 1 DAY {int(hour)} HOURS")
