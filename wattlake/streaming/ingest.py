"""Event streams to silver, to gold directly, to the console."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from wattlake.operators.latest import latest_per_key
from wattlake.operators.layers import (
    direct_gold_carbon, direct_gold_mix, has_key, silver_carbon, silver_mix,
)
from wattlake.operators.parse import (
    display_rows, parse_carbon, parse_mix, quarantine, without_good_text,
)
from wattlake.operators.partials import day_zone_partials
from wattlake.sinks.tables import append_batch, append_partials, upsert_gold


# where a batch goes: a folder, or a function of the rows and the batch id
Sink = str | Callable[[DataFrame, int], None]


def _append_to(sink: Sink) -> Callable[[DataFrame, int], None]:
    if callable(sink):
        return sink
    return lambda rows, batch_id: append_batch(rows, sink, "processing_time", batch_id)


def _upsert_to(sink: Sink) -> Callable[[DataFrame, int], None]:
    return sink if callable(sink) else lambda rows, batch_id: upsert_gold(rows, sink)


def _two_sinks(
    parsed: DataFrame, keep: Callable[[DataFrame], DataFrame], value: str | None, silver: Sink,
    rejects: Sink, partials: str | None = None,
) -> DataStreamWriter:
    """Everything is derived on the stream; foreachBatch only writes. An error is
    not caught: the query fails and the batch comes again at the next start.

    Folders hold a repeated batch once. A sink without keys, such as a JDBC
    append, gets it again; gold keeps the last arrival in either case. ``partials`` is
    the folder of the sums by event day and zone that reports read.
    """
    to_silver, to_rejects = _append_to(silver), _append_to(rejects)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            to_silver(keep(batch), batch_id)
            if partials is not None:
                append_partials(day_zone_partials(keep(batch), value), partials, batch_id)
            to_rejects(quarantine(batch, value), batch_id)
        finally:
            batch.unpersist()

    held = without_good_text(parsed, value)
    return held.writeStream.outputMode("append").foreachBatch(write)


def mix_to_silver(
    events: DataFrame, silver: Sink, rejects: Sink, arrival: str | None = None,
    extras: bool = False, partials: str | None = None,
) -> DataStreamWriter:
    return _two_sinks(
        parse_mix(events, arrival=arrival), lambda rows: silver_mix(rows, extras),
        "production_total", silver, rejects, partials,
    )


def carbon_to_silver(
    events: DataFrame, silver: Sink, rejects: Sink, arrival: str | None = None,
    extras: bool = False, partials: str | None = None,
) -> DataStreamWriter:
    return _two_sinks(
        parse_carbon(events, arrival=arrival), lambda rows: silver_carbon(rows, extras),
        "carbon_intensity", silver, rejects, partials,
    )


def upserts(rows: DataFrame, gold: Sink) -> DataStreamWriter:
    """Each batch into gold, last write per key. Only the newest row per key of the
    batch is held while its days are looked up and merged."""
    to_gold = _upsert_to(gold)

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch).persist()
        try:
            if not newest.isEmpty():
                to_gold(newest, batch_id)
        finally:
            newest.unpersist()

    return rows.writeStream.outputMode("append").foreachBatch(write)


def _direct(
    parsed: DataFrame, shape: Callable[[DataFrame], DataFrame], gold: Sink, rejects: Sink
) -> DataStreamWriter:
    to_gold = _upsert_to(gold)

    def newest(rows: DataFrame, batch_id: int) -> None:
        to_gold(latest_per_key(rows), batch_id)

    return _two_sinks(parsed, lambda rows: has_key(shape(rows)), None, newest, rejects)


def mix_to_gold(
    events: DataFrame, gold: Sink, rejects: Sink, breakdown: str = "consumption",
    arrival: str | None = None,
) -> DataStreamWriter:
    """The direct path: no silver, nulls kept. Malformed rows and rows without a key
    go to the rejects with their text."""
    parsed = parse_mix(events, breakdown, arrival, strict=True)
    return _direct(parsed, direct_gold_mix, gold, rejects)


def carbon_to_gold(
    events: DataFrame, gold: Sink, rejects: Sink, arrival: str | None = None
) -> DataStreamWriter:
    return _direct(parse_carbon(events, arrival, strict=True), direct_gold_carbon, gold, rejects)


def mix_to_console(events: DataFrame, rows: int = 20) -> DataStreamWriter:
    shown = display_rows(events).select(
        "region", "date_heure", "nucleaire", "eolien", "solaire", "processing_time"
    )
    return shown.writeStream.outputMode("append").format("console").options(
        numRows=rows, truncate=False
    )


def raw_text(events: DataFrame) -> DataFrame:
    """Message text on one line (a line break inside JSON is only layout), with
    the directory columns."""
    return events.select(
        F.regexp_replace(F.col("value").cast("string"), r"[\r\n]+", " ").alias("value"),
        F.col("topic"),
        F.col("partition"),
        F.to_date("timestamp").alias("date"),
    ).filter(F.col("value").isNotNull())


def land(events: DataFrame, path: str) -> DataStreamWriter:
    """Raw messages per topic and day. File names are Spark's, so two messages
    of one second never overwrite each other."""
    return (
        raw_text(events).drop("partition").writeStream.outputMode("append")
        .format("text").partitionBy("topic", "date").option("path", path)
    )


def land_rolled(events: DataFrame, path: str, records: int) -> DataStreamWriter:
    """Raw messages per topic and partition, at most ``records`` in one file."""
    return (
        raw_text(events).drop("date").writeStream.outputMode("append")
        .format("text").partitionBy("topic", "partition")
        .option("maxRecordsPerFile", records).option("path", path)
    )
