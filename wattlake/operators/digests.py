"""Reconciliation of silver and gold by digests: first per day, then per hour of the days
that differ, then row by row in the hours that differ."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wattlake import vocabulary as V
from wattlake.operators.latest import DAY
from wattlake.sources.scratch import new_path

HOUR = "hour"


def silver_keys(silver: DataFrame) -> DataFrame:
    """One row per (region, timestamp) of silver with its arrivals and the newest of them."""
    return silver.groupBy(
        F.col("zone").alias("region"), F.col("datetime").alias("timestamp")
    ).agg(F.count("*").alias("arrivals"), F.max("processing_time").alias("arrived"))


def key_digests(rows: DataFrame, arrived: str, by: list[Column | str]) -> DataFrame:
    """Number of keys, their digest whatever their order, and the newest arrival. Keys are
    unique, so no two of them cancel each other out in the sum of bits."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(*V.KEY, arrived)).alias("digest"), F.max(arrived).alias("last")
    )


def _compared(silver: DataFrame, gold: DataFrame, by: list[str]) -> DataFrame:
    """Both digests of each group of rows of either side, and whether they agree."""
    ours = silver.select(*by, F.col("n").alias("silver_n"), F.col("digest").alias("silver_digest"))
    theirs = gold.select(*by, F.col("n").alias("gold_n"), F.col("digest").alias("gold_digest"), F.col("last").alias("gold_last"))
    same = F.col("silver_n").eqNullSafe(F.col("gold_n")) & F.col("silver_digest").eqNullSafe(F.col("gold_digest"))
    return ours.join(theirs, by, "full").withColumn("same", same)


def _agreed(compared: DataFrame) -> DataFrame:
    return compared.filter("same").agg(F.sum("silver_n").alias("gold_keys"), F.max("gold_last").alias("gold_last"))


def differing_rows(keys: DataFrame, gold: DataFrame, days: list, hours: DataFrame) -> DataFrame:
    """Keys of silver in the hours that differ, with the arrival that gold has of them.
    Only the folders of ``days`` are read; an hour per row is sent to the tasks."""
    hour = F.date_trunc("hour", "timestamp")
    sent = F.broadcast(hours.select(F.col(HOUR)))
    ours, theirs = (
        df.filter(F.col(DAY).isin(days)).withColumn(HOUR, hour).join(sent, HOUR, "left_semi") for df in (keys, gold)
    )
    held = theirs.select(*V.KEY, F.col("ingestion_timestamp").alias("stored_at"))
    return ours.join(held, V.KEY, "left")


def reconcile_by_digests(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: silver_rows, silver_keys, unkeyed_rows, gold_keys, missing_keys, stale_keys,
    silver_last, gold_last, in_sync.

    ``gold`` is stored by day. Silver is reduced to its keys once, by the only exchange
    of rows; they are stored by day. Days and their digests are as many as the calendar
    has, the hours of the days that differ 24 times as many.
    """
    spark = silver.sparkSession
    path = new_path(spark, "silver_keys")
    by_key = silver_keys(silver).withColumn(DAY, F.to_date("timestamp"))
    by_key.hint("rebalance", DAY).write.partitionBy(DAY).parquet(path)
    keys = spark.read.schema(by_key.schema).parquet(path)
    usable = keys.filter("timestamp IS NOT NULL")
    totals = keys.agg(
        F.sum("arrivals").alias("silver_rows"), F.count("timestamp").alias("silver_keys"),
        F.sum(F.when(F.col("timestamp").isNull(), F.col("arrivals"))).alias("unkeyed_rows"),
        F.max("arrived").alias("silver_last"),
    )
    by_day = _stored(_compared(key_digests(usable, "arrived", [DAY]), key_digests(gold, "ingestion_timestamp", [DAY]), [DAY]), "days")
    parts = [totals, _agreed(by_day)]
    days = [row[DAY] for row in by_day.filter("NOT same").select(DAY).collect()]
    if days:
        some = [df.filter(F.col(DAY).isin(days)) for df in (usable, gold)]
        hour = F.date_trunc("hour", "timestamp").alias(HOUR)
        by_hour = _stored(_compared(
            key_digests(some[0], "arrived", [hour]), key_digests(some[1], "ingestion_timestamp", [hour]), [HOUR]
        ), "hours")
        rows = differing_rows(usable, gold, days, by_hour.filter("NOT same"))
        parts += [_agreed(by_hour), rows.agg(
            F.count("stored_at").alias("gold_keys"), F.count_if(F.col("stored_at").isNull()).alias("missing_keys"),
            F.count_if(F.col("stored_at") < F.col("arrived")).alias("stale_keys"), F.max("stored_at").alias("gold_last"),
        )]
    counted = ["silver_rows", "silver_keys", "unkeyed_rows", "gold_keys", "missing_keys", "stale_keys"]
    none = spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in counted])
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, none)
    return every.agg(
        *[F.sum(c).alias(c) for c in counted], F.max("silver_last").alias("silver_last"), F.max("gold_last").alias("gold_last")
    ).withColumn("in_sync", F.col("missing_keys") == 0)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.coalesce(1).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
