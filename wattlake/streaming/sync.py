"""Silver to gold: as a stream over the silver files, or as a marked batch job
over a table in a database."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from wattlake import vocabulary as V
from wattlake.operators.latest import high_water_mark, latest_per_key, since
from wattlake.operators.layers import has_key
from wattlake.sinks.tables import append_table, upsert_gold
from wattlake.sources.files import delete, exists
from wattlake.sources.scratch import materialize, new_path
from wattlake.streaming.ingest import Sink, upserts

MARKS = "table_name string, mark timestamp, saved_at timestamp"


def silver_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Silver as a stream of its new files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def sync_stream(
    silver: DataFrame, shape: Callable[[DataFrame], DataFrame], gold: Sink
) -> DataStreamWriter:
    """The mark is the checkpoint: no row is skipped and none is read from gold."""
    return upserts(has_key(shape(silver)), gold)


def read_mark(spark: SparkSession, marks: str, name: str) -> dt.datetime | None:
    if not exists(spark, marks):
        return None
    saved = spark.read.schema(MARKS).parquet(marks).filter(F.col("table_name") == name)
    return high_water_mark(saved, "mark")


def sync_batch(
    spark: SparkSession, silver: DataFrame, shape: Callable[[DataFrame], DataFrame], gold: str,
    marks: str, name: str, overlap: str = "10 minutes", stored_by: str | None = None,
) -> dt.datetime | None:
    """One round for a silver table without a stream, e.g. read over JDBC.

    The mark is kept beside the tables and saved after the gold write. Rows are
    read again from ``overlap`` before it, for those that were committed late with
    an older stamp; the upsert makes the repetition harmless. ``repair`` finds what
    was committed later still.
    """
    mark = read_mark(spark, marks, name)
    fresh = silver
    if mark is not None:
        fresh = since(silver, F.lit(mark) - F.expr(f"INTERVAL {overlap}"), "processing_time",
                      stored_by)
    # the slice is read once; rows that arrive during this round belong to the next
    path = new_path(spark, "slice")
    fresh = materialize(fresh, path)
    end = high_water_mark(fresh)
    if end is None:
        delete(spark, path)
        return mark
    upsert_gold(has_key(shape(fresh)), gold)
    delete(spark, path)
    saved = spark.range(1).select(
        F.lit(name).alias("table_name"), F.lit(end).alias("mark"),
        F.current_timestamp().alias("saved_at"),
    )
    append_table(saved, path=marks)
    return end


def missing_in_gold(rows: DataFrame, gold: DataFrame) -> DataFrame:
    """Of rows in gold shape the last per key that gold does not have, or has older."""
    newest = latest_per_key(has_key(rows))
    stored = gold.select(*V.KEY, F.col("ingestion_timestamp").alias("stored_at"))
    return (
        newest.join(stored, V.KEY, "left")
        .filter(F.col("stored_at").isNull() | (F.col("stored_at") < F.col("ingestion_timestamp")))
        .drop("stored_at")
    )


def repair(
    spark: SparkSession, silver: DataFrame, shape: Callable[[DataFrame], DataFrame], gold: str
) -> int:
    """Compares all of silver with gold and upserts what is missing or older. Returns
    the number of rows."""
    path = new_path(spark, "missing")
    rows = materialize(missing_in_gold(shape(silver), spark.read.parquet(gold)), path)
    count = rows.count()
    if count:
        upsert_gold(rows, gold)
    delete(spark, path)
    return count
