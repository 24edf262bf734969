"""Table scans: files, JDBC, key-table connectors."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators.latest import newer_than


def read_table(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet",
    options: dict[str, str] | None = None, schema=None,
) -> DataFrame:
    """A stored table. With a connector format give ``options`` (table, keyspace)
    instead of a path."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """A table with a folder per day. Spark lists the folders when a table is opened, by
    default with a task for each folder; here by a few tasks a core."""
    before = int(spark.conf.get(LISTING_TASKS))
    spark.conf.set(LISTING_TASKS, str(min(before, 4 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(LISTING_TASKS, str(before))


V1_SOURCES = "spark.sql.sources.useV1SourceList"


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table for counts, and for the least and greatest whole numbers and days,
    of all rows or by partition: Spark takes them from the footers of the Parquet files
    and reads no column. Other questions are answered as by ``read_table``.

    Which of its two readers Spark takes is decided when a table is opened, so the
    setting is changed for that moment only.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    others = spark.conf.get(V1_SOURCES)
    spark.conf.set(V1_SOURCES, ",".join(s for s in others.split(",") if s.strip().lower() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, others)


@dataclass(frozen=True)
class JdbcSlices:
    """Parallel read: ``count`` slices of ``column`` between the bounds. Rows
    outside the bounds go into the outer slices, none is lost."""

    column: str
    lower: str
    upper: str
    count: int


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    slices: JdbcSlices | None = None,
) -> DataFrame:
    """Filters and columns are pushed to the database by Spark. Without slices
    the whole table goes through one task: give them for anything large."""
    if slices is None:
        return spark.read.jdbc(url, table, properties=properties)
    return (
        spark.read.format("jdbc")
        .options(**properties)
        .options(url=url, dbtable=table, partitionColumn=slices.column, lowerBound=slices.lower,
                 upperBound=slices.upper, numPartitions=str(slices.count))
        .load()
    )


def read_incremental(
    table: DataFrame, mark: dt.datetime | None, column: str = "processing_time",
    stored_by: str | None = None,
) -> DataFrame:
    """Rows above the mark, the full table when there is none. Silver is stored by
    the day of ``processing_time``, gold by that of ``timestamp``."""
    return newer_than(table, mark, column, stored_by)
