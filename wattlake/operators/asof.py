"""The last known state at a time: for one time of all regions, and for a table of times."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlake.operators.latest import DAY


def until(gold: DataFrame, at: Column | dt.datetime) -> DataFrame:
    """Rows at or before a time; a table stored by day is read up to that day."""
    if DAY in gold.columns:
        gold = gold.filter(F.col(DAY) <= F.to_date(F.lit(at)))
    return gold.filter(F.col("timestamp") <= F.lit(at))


def as_of_join(
    rows: DataFrame, states: DataFrame, values: list[str], state_time: str = "state_time",
    region: str = "region", time: str = "timestamp",
) -> DataFrame:
    """Every row of ``rows`` with the ``values`` of the newest state of its region at or
    before its time, and that state's time; null where there is none.

    Rows and states of a region and day stand in one order of time, and the last state is
    carried forward. A day begins with the last state of the days before it, found among
    one state per region and day, so neither a region nor its history is one task.
    ``values`` and ``state_time`` must not be columns of ``rows``. A row without region
    or time stays and has no state; states without either are left out. States of one
    region and time are ordered by their values.
    """
    kept = rows.columns
    state = F.struct(F.col(time).alias("_time"), *[F.col(v) for v in values])
    usable = F.col(region).isNotNull() & F.col(time).isNotNull()
    known = states.filter(usable).select(
        F.col(region).alias("_region"), F.to_date(time).alias("_day"), F.col(time).alias("_at"), state.alias("_state")
    )
    left = rows.filter(usable).select(
        F.col(region).alias("_region"), F.to_date(time).alias("_day"), F.col(time).alias("_at"), F.struct(*kept).alias("_row")
    )
    # One row per region and day: the calendar bounds what a region has of them.
    last = known.groupBy("_region", "_day").agg(F.max("_state").alias("_state"))
    asked = left.select("_region", "_day").distinct().withColumn("_asked", F.lit(True))
    before = Window.partitionBy("_region").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last.join(asked, ["_region", "_day"], "full")
        .withColumn("_state", F.last("_state", ignorenulls=True).over(before))
        .filter("_asked AND _state IS NOT NULL")
        .select("_region", "_day", F.col("_day").cast("timestamp").alias("_at"), "_state", F.lit(0).alias("_rank"))
    )
    marks = (
        carried.unionByName(known.withColumn("_rank", F.lit(1)))
        .withColumn("_row", F.lit(None).cast(left.schema["_row"].dataType))
        .unionByName(
            left.withColumn("_rank", F.lit(2)).withColumn("_state", F.lit(None).cast(known.schema["_state"].dataType))
        )
    )
    so_far = Window.partitionBy("_region", "_day").orderBy("_at", "_rank", "_state").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = marks.withColumn("_found", F.last("_state", ignorenulls=True).over(so_far)).filter("_row IS NOT NULL")
    joined = found.select(
        "_row.*", F.col("_found._time").alias(state_time), *[F.col(f"_found.{v}").alias(v) for v in values]
    )
    return joined.unionByName(rows.filter(~usable), allowMissingColumns=True)
