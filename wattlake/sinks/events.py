"""Enrichment and JSON encoding of readings, publication to a topic."""

from pyspark.sql import Column, DataFrame, functions as F

from wattlake.functions.calendar import epoch_seconds
from wattlake.vocabulary import EVENT

KAFKA_DELIVERY = {"kafka.acks": "all", "kafka.retries": "5"}


def enrich(readings: DataFrame, now: Column | None = None, zone: Column | None = None) -> DataFrame:
    """Adds the polling time to each ``reading``, and the polled zone if given:
    ``timestamp`` in epoch seconds, ``date_processing`` as text."""
    now = F.current_timestamp() if now is None else now
    reading = F.col("reading")
    if zone is not None:
        reading = reading.withField("zone", zone)
    return readings.withColumn(
        "reading",
        reading.withField("timestamp", epoch_seconds(now)).withField(
            "date_processing", F.date_format(now, "yyyy-MM-dd HH:mm:ss")
        ),
    )


def encode_events(readings: DataFrame, topic: str) -> DataFrame:
    """Kafka-shaped records whose value is the reading as JSON; null fields are
    left out. Arrival columns are filled when the input has them."""
    have = set(readings.columns)
    given = {
        "key": F.lit(None),
        "value": F.to_json("reading").cast("binary"),
        "topic": F.lit(topic),
        "partition": F.col("partition") if "partition" in have else F.lit(None),
        "offset": F.col("offset") if "offset" in have else F.lit(None),
        "timestamp": F.col("arrival") if "arrival" in have else F.lit(None),
        "timestampType": F.lit(0),
    }
    columns = {f.name: given[f.name].cast(f.dataType) for f in EVENT.fields}
    rest = [c for c in readings.columns if c not in columns and c not in ("reading", "arrival")]
    return readings.select(*[c.alias(n) for n, c in columns.items()], *rest)


def publish(events: DataFrame, servers: str, **options: str) -> None:
    """Batch write to Kafka; the topic is taken from the rows."""
    events.select("key", "value", "topic").write.format("kafka").options(
        **{**KAFKA_DELIVERY, "kafka.bootstrap.servers": servers, **options}
    ).save()
