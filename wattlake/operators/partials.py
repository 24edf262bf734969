"""Counts and sums of silver by event day and zone, from which reports are made.

A batch of silver adds its own partials, under its own id; a report merges those of the
days that it asks for. Late events belong to their day, whenever they arrive.
"""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions.calendar import start_of_yesterday
from wattlake.operators.latest import DAY, newer_than

ZONE = [DAY, "zone"]


def day_zone_partials(silver: DataFrame, value: str) -> DataFrame:
    """(date, zone, records, valued, total, last_update); a row without event time has no
    day. Combined before its one exchange."""
    return silver.groupBy(F.to_date("datetime").alias(DAY), "zone").agg(
        F.count("*").alias("records"), F.count(value).alias("valued"), F.sum(value).alias("total"),
        F.max("processing_time").alias("last_update"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per day and zone."""
    return partials.groupBy(*ZONE).agg(
        F.sum("records").alias("records"), F.sum("valued").alias("valued"), F.sum("total").alias("total"),
        F.max("last_update").alias("last_update"),
    )


def top_zones(partials: DataFrame, as_of: Column | dt.datetime, limit: int = 5) -> DataFrame:
    """As the report of this name on silver; reads the folders of the days since
    yesterday only, which hold a row per zone and batch."""
    first = F.to_date(start_of_yesterday(F.lit(as_of)))
    return (
        partials.filter(F.col(DAY) >= first).groupBy("zone")
        .agg(
            F.sum("records").alias("records"),
            F.round(F.sum("total") / F.sum("valued"), 0).alias("avg_prod"),
        )
        .orderBy(F.desc("avg_prod"), "zone").limit(limit)
    )


def table_stats(partials: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, zones, last update."""
    return reduce(DataFrame.unionByName, [
        df.agg(
            F.coalesce(F.sum("records"), F.lit(0)).alias("row_count"), F.countDistinct("zone").alias("zones"),
            F.max("last_update").alias("last_update"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in partials.items()
    ])


def freshness(
    partials: dict[str, DataFrame], silver: dict[str, DataFrame], as_of: Column | dt.datetime
) -> DataFrame:
    """As the report of this name on silver. Only the last ten minutes are counted there,
    in the folders of the days in which they lie."""
    since = F.lit(as_of) - F.expr("INTERVAL 10 MINUTES")
    recent = reduce(DataFrame.unionByName, [
        newer_than(rows, since, stored_by="processing_time").agg(F.count("*").alias("recent_rows"))
        .select(F.lit(name).alias("table_name"), "recent_rows")
        for name, rows in silver.items()
    ])
    both = table_stats(partials).drop("zones").unionByName(recent, allowMissingColumns=True)
    return both.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"), F.max("last_update").alias("last_update"),
        F.max("recent_rows").alias("recent_rows"), (F.max("row_count") == 0).alias("is_empty"),
    )
