"""Counts, freshness, reconciliation and the leading zones."""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions.calendar import start_of_yesterday


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("table_name"), "*")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _union([
        _named(df.agg(F.count("*").alias("row_count")), name) for name, df in tables.items()
    ])


def freshness(tables: dict[str, DataFrame], as_of: Column | dt.datetime) -> DataFrame:
    """Per table: rows, last update, rows of the last ten minutes, empty or not."""
    recent = F.col("processing_time") > F.lit(as_of) - F.expr("INTERVAL 10 MINUTES")
    return _union([
        _named(
            df.agg(
                F.count("*").alias("row_count"),
                F.max("processing_time").alias("last_update"),
                F.count_if(recent).alias("recent_rows"),
                (F.count("*") == 0).alias("is_empty"),
            ),
            name,
        )
        for name, df in tables.items()
    ])


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, zones, last update."""
    return _union([
        _named(
            df.agg(
                F.count("*").alias("row_count"),
                F.countDistinct("zone").alias("zones"),
                F.max("processing_time").alias("last_update"),
            ),
            name,
        )
        for name, df in tables.items()
    ])


def count_by_region(gold: DataFrame) -> DataFrame:
    return gold.groupBy("region").agg(F.count("*").alias("row_count"))


def top_zones(
    silver_mix: DataFrame, as_of: Column | dt.datetime, limit: int = 5
) -> DataFrame:
    """Zones with the highest mean production since yesterday 00:00."""
    return (
        silver_mix.filter(F.col("datetime") >= start_of_yesterday(F.lit(as_of)))
        .groupBy("zone")
        .agg(
            F.count("*").alias("records"),
            F.round(F.avg("production_total"), 0).alias("avg_prod"),
        )
        .orderBy(F.desc("avg_prod"), "zone")
        .limit(limit)
    )


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per table pair (silver, gold): do all silver keys have a gold row?

    Silver is reduced to one row per key before it meets gold.
    """
    parts = []
    for name, (silver, gold) in pairs.items():
        keys = silver.groupBy(
            F.col("zone").alias("region"), F.col("datetime").alias("timestamp")
        ).agg(F.count("*").alias("arrivals"), F.max("processing_time").alias("arrived"))
        held = gold.select("region", "timestamp", "ingestion_timestamp", F.lit(True).alias("held"))
        usable = F.col("timestamp").isNotNull()
        matched = keys.join(held, ["region", "timestamp"], "left")
        parts.append(_named(
            matched.agg(
                F.coalesce(F.sum("arrivals"), F.lit(0)).alias("silver_rows"),
                F.count_if(usable).alias("silver_keys"),
                F.coalesce(F.sum(F.when(~usable, F.col("arrivals"))), F.lit(0)).alias("unkeyed_rows"),
                F.count_if(F.col("held")).alias("gold_keys"),
                F.count_if(usable & F.col("held").isNull()).alias("missing_keys"),
                F.max("arrived").alias("silver_last"),
                F.max("ingestion_timestamp").alias("gold_last"),
            ),
            name,
        ))
    return _union(parts).withColumn("in_sync", F.col("missing_keys") == 0)


def flow_report(silver: dict[str, DataFrame], gold: DataFrame) -> DataFrame:
    """One row: totals of both silver tables, gold rows, zones per table."""
    return flow_of(table_stats(silver), list(silver), gold)


def flow_of(stats: DataFrame, names: list[str], gold: DataFrame) -> DataFrame:
    """The same from the statistics of the silver tables; gold rows are counted, from
    file footers if gold was opened for that."""
    totals = stats.agg(
        F.sum("row_count").alias("silver_total"),
        *[
            F.max(F.when(F.col("table_name") == name, F.col("zones"))).alias(f"{name}_zones")
            for name in names
        ],
    )
    counted = ["silver_total", "gold_total"] + [f"{name}_zones" for name in names]
    return (
        totals.withColumn("gold_total", F.lit(None).cast("long"))
        .unionByName(
            gold.agg(F.count("*").alias("gold_total")), allowMissingColumns=True
        )
        .agg(*[F.max(c).alias(c) for c in counted])
        .withColumn(
            "status",
            F.when(F.col("silver_total") == 0, "empty")
            .when(F.col("gold_total") == 0, "gold_pending")
            .otherwise("success"),
        )
    )


def preview(df: DataFrame, order: list[str], rows: int = 10) -> DataFrame:
    """First rows in key order: a bounded top-k, never a full sort."""
    return df.orderBy(*order).limit(rows)


def landing_summary(listing: DataFrame) -> DataFrame:
    """Number and size of the landed objects, the newest time, present or not."""
    return listing.agg(
        F.count("*").alias("objects"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("newest"),
        (F.count("*") > 0).alias("present"),
    )


def newest_objects(listing: DataFrame, limit: int = 5) -> DataFrame:
    return (
        listing.orderBy(F.desc("modificationTime"), "path").limit(limit)
        .select("path", "modificationTime", "length")
    )
