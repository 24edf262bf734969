"""Energy messages derived from the ``events`` table, for tests and trials.

Every event makes one mix message and one carbon message. The number ``k`` in
``props`` doubles as a fault code, so that each kind of bad message occurs.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattlake import vocabulary as V
from wattlake.functions.calendar import iso_utc
from wattlake.sinks.events import encode_events, enrich

SOURCE_OF_EVENT = {
    "click": "nuclear", "view": "wind", "purchase": "solar", "signup": "hydro", "error": "gas",
}
NO_CARBON, NO_TIME, NO_TOTAL, NO_ZONE, BROKEN = 73, 79, 83, 89, 97
PARTITIONS = 4


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _unless(code: int, value: Column) -> Column:
    return F.when(F.col("k") != code, value)


def _breakdown(value: Column, *others: Column) -> Column:
    return F.struct(
        *[
            F.when(F.col("event_type") == event, value).alias(source)
            for event, source in SOURCE_OF_EVENT.items()
        ],
        *others,
    )


def _facts(events: DataFrame) -> DataFrame:
    zones = F.array(*[F.lit(z) for z in V.ZONES])
    return (
        events.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
        .withColumn("arrival", F.col("ts").cast("timestamp"))
        .withColumn("owner", zones[(F.col("user_id") % len(V.ZONES)).cast("int")])
    )


def _place(columns: list[Column]) -> list[Column]:
    """The message fields, then where and when it arrived."""
    return [
        F.struct(*columns).alias("reading"),
        F.col("owner"),
        F.col("arrival"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        (F.col("k") == BROKEN).alias("broken"),
    ]


def _time_fields() -> list[Column]:
    return [
        _unless(NO_ZONE, F.col("owner")).alias("zone"),
        _unless(NO_TIME, iso_utc(F.date_trunc("hour", "arrival"))).alias("datetime"),
        iso_utc(F.col("arrival")).alias("updatedAt"),
    ]


def mix_readings(events: DataFrame) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    return _facts(events).select(*_place([
        *_time_fields(),
        _breakdown(
            value + k, (k / 4).alias("geothermal"), (k / 2).alias("oil"),
            k.cast("double").alias("hydro discharge"), (-k).cast("double").alias("battery discharge"),
        ).alias("powerConsumptionBreakdown"),
        _breakdown(value).alias("powerProductionBreakdown"),
        _unless(NO_TOTAL, value).alias("powerProductionTotal"),
        (value + k).alias("powerConsumptionTotal"),
        (k * 2).cast("double").alias("powerImportTotal"),
        k.cast("double").alias("powerExportTotal"),
        F.least(F.lit(100), k + 10).cast("double").alias("fossilFreePercentage"),
        k.cast("double").alias("renewablePercentage"),
    ]))


def carbon_readings(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return _facts(events).select(*_place([
        *_time_fields(),
        _unless(NO_CARBON, (k * 5).cast("double")).alias("carbonIntensity"),
        F.when(k >= 66, "direct").when(k >= 33, "lifecycle").alias("emissionFactorType"),
        (k < 25).alias("isEstimated"),
        F.when(k < 25, "TIME_SLICER_AVERAGE").alias("estimationMethod"),
    ]))


def _events(readings: DataFrame, topic: str) -> DataFrame:
    """As the topic would deliver them; broken messages are cut off."""
    sent = encode_events(enrich(readings, F.col("arrival")), topic)
    bad = F.lit("{bad").cast("binary")
    return sent.withColumn("value", F.when(F.col("broken"), bad).otherwise(F.col("value"))).select(
        *V.EVENT.names
    )


def mix_events(events: DataFrame) -> DataFrame:
    return _events(mix_readings(events), V.TOPIC_MIX)


def carbon_events(events: DataFrame) -> DataFrame:
    return _events(carbon_readings(events), V.TOPIC_CARBON)
