"""Event streams: Kafka, or files with the columns of a Kafka record."""

from pyspark.sql import DataFrame, SparkSession

from wattlake.vocabulary import EVENT

# nothing is skipped in silence; a live view may ask for latest and false by option
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options for one topic. For a large topic give ``minPartitions`` and
    ``maxOffsetsPerTrigger`` too."""
    return {**KAFKA_DEFAULTS, "kafka.bootstrap.servers": servers, "subscribe": topic, **more}


def read_events(
    spark: SparkSession, fmt: str, options: dict[str, str] | None = None, streaming: bool = True
) -> DataFrame:
    """``fmt`` is ``kafka`` (needs its package on the cluster) or a file format,
    with ``path`` among the options."""
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    options = dict(options or {})
    if fmt == "kafka":
        return reader.options(**options).load()
    path = options.pop("path")
    return reader.schema(EVENT).options(**options).load(path)
