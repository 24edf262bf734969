"""Silver append and gold upsert on files; JDBC and connector tables by option."""

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

from wattlake import vocabulary as V
from wattlake.operators.latest import DAY, WRITE_ORDER, latest_per_key
from wattlake.operators.partials import merge_partials
from wattlake.sources.files import children, delete, exists, move
from wattlake.sources.tables import read_days, read_footers

BATCH = "batch_id"
#: Arrival of a gold row in microseconds, as file footers tell the greatest of whole
#: numbers but not of times. Never null, as a footer without a greatest value is an error.
STAMP = "ingestion_micros"
NO_STAMP = -(2**63)
#: Gold files are in order of the region and have a Bloom filter of it where the
#: regions of a row group are too many for a dictionary.
REGION_LAYOUT = {
    "parquet.bloom.filter.enabled#region": "true", "parquet.bloom.filter.adaptive.enabled": "true",
}


def by_day(df: DataFrame, time_column: str) -> DataFrame:
    """Adds the partition column and evens out the output files.

    The rebalance hint keeps rows of a day together, and splits a day that is
    larger than the advisory size over several tasks.
    """
    return df.withColumn(DAY, F.to_date(time_column)).hint("rebalance", DAY)


def append_batch(df: DataFrame, path: str, time_column: str, batch_id: int) -> None:
    """Appends one micro-batch. A replayed batch replaces its own files only, so
    appending twice does not double the rows."""
    (
        by_day(df, time_column)
        .withColumn(BATCH, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .parquet(path)
    )


def append_partials(partials: DataFrame, path: str, batch_id: int) -> None:
    """Partial sums of one micro-batch, a folder per event day and batch. A replayed
    batch replaces its own."""
    (
        partials.withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", DAY)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH).parquet(path)
    )


def rebuild_partials(partials: DataFrame, path: str) -> None:
    """The sums of all of silver in the place of those that are there. They bear no batch's
    id, so that batches to come add to them."""
    staged = f"{_stage(path)}/{uuid.uuid4().hex}"
    append_partials(partials, staged, -1)
    move(partials.sparkSession, staged, path)


def append_table(
    df: DataFrame, fmt: str = "parquet", path: str | None = None,
    options: dict[str, str] | None = None, partition_by: list[str] | None = None,
) -> int:
    """One append, to files, JDBC (``url``, ``dbtable``, ...) or a connector's
    table; the rows written are counted on the way, without a second scan."""
    seen = Observation("append")
    counted = df.observe(seen, F.count(F.lit(1)).alias("row_count"))
    writer = counted.write.mode("append").format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path else writer.save()
    return seen.get["row_count"]


def _gold_writer(rows: DataFrame) -> DataFrameWriter:
    """Whole days, each file in key order: a reader of few regions skips most row groups
    and pages."""
    stamp = F.coalesce(F.unix_micros("ingestion_timestamp"), F.lit(NO_STAMP))
    stored = by_day(rows.withColumn(STAMP, stamp), "timestamp").sortWithinPartitions(DAY, *V.KEY)
    return stored.write.mode("overwrite").options(**REGION_LAYOUT).partitionBy(DAY)


def write_gold(rows: DataFrame, path: str) -> None:
    """First load of a gold table from rows that are already latest per key."""
    _gold_writer(rows).parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_days(spark, path).drop(STAMP)


def write_bucketed(rows: DataFrame, path: str, buckets: int) -> None:
    """Gold whose rows are dealt by key into ``buckets`` files a day. Two tables of equal
    bucket counts are joined and grouped by key without an exchange. ``buckets`` is fixed
    for a table: a few times the cores of the cluster, so that a bucket of the days of
    one question fits a task."""
    spark = rows.sparkSession
    stored = rows.withColumn(DAY, F.to_date("timestamp")).repartition(buckets, *V.KEY)
    # Files are told their bucket only when written as a table; the entry goes again.
    name = f"writing_{uuid.uuid4().hex}"
    (
        stored.write.mode("overwrite").options(**REGION_LAYOUT).partitionBy(DAY)
        .bucketBy(buckets, *V.KEY).sortBy(*V.KEY).option("path", path).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The table by its entry in the catalog, which is made from the files where it is
    missing: another session, or another catalog, needs the path and the bucket count only."""
    name = "gold_" + hashlib.md5(f"{path}:{buckets}".encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = [f for f in spark.read.parquet(path).schema if f.name != DAY]
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        keys = ", ".join(V.KEY)
        spark.sql(
            f"CREATE TABLE {name} ({listed}, {DAY} DATE) USING parquet PARTITIONED BY ({DAY}) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def upsert_gold(rows: DataFrame, path: str, buckets: int | None = None) -> None:
    """Last write wins on (region, timestamp); repeating a batch changes nothing.

    Of the days that occur in ``rows`` the keys are read, and only days for which a row
    is newer than what is stored are rewritten: rows read once more, or late ones that a
    newer row has overtaken, cost no writing. One writer per gold table. ``buckets`` is
    that of a bucketed table, which stays one.
    """
    spark = rows.sparkSession
    finish_swap(spark, path)
    incoming = rows.withColumn(DAY, F.to_date("timestamp"))
    touched = _touched(spark, path, incoming)
    if touched is None:
        replace_days(latest_per_key(incoming.drop(DAY)), path, buckets)
        return
    newer = _newer(incoming, touched)
    days = [row[DAY] for row in newer.select(DAY).distinct().collect()]  # as many as in the batch at most
    if days:
        kept = touched.filter(F.col(DAY).isin(days))
        replace_days(latest_per_key(newer.unionByName(kept).drop(DAY)), path, buckets)


def _newer(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows that are the last write of their key so far."""
    known = stored.select(*V.KEY, DAY, F.struct(*WRITE_ORDER).alias("_stored"))
    joined = incoming.join(known, [*V.KEY, DAY], "left")
    newer = F.col("_stored").isNull() | (F.struct(*WRITE_ORDER) > F.col("_stored"))
    return joined.filter(newer).select(*incoming.columns)


def replace_days(days: DataFrame, path: str, buckets: int | None = None) -> None:
    """Puts whole days in the place of the same days of the table.

    They are written beside the table first, once, and then moved day by day. A
    driver lost in between leaves the days not yet moved complete beside the table;
    the next writer moves them. A reader that lists the table between the two steps of
    a move does not see that day; one that planned its files before fails on those that
    have gone and has to read again. It never sees a day half written or twice.
    """
    staged = f"{_stage(path)}/{uuid.uuid4().hex}"
    write_bucketed(days, staged, buckets) if buckets else write_gold(days, staged)
    finish_swap(days.sparkSession, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Moves complete staged days into the table, drops incomplete ones."""
    for staged in children(spark, _stage(path)):
        holds_days = any(f"/{DAY}=" in child for child in children(spark, staged))
        if holds_days and exists(spark, f"{staged}/_SUCCESS"):
            for day in children(spark, staged):
                name = day.rstrip("/").rsplit("/", 1)[-1]
                if name.startswith(f"{DAY}="):
                    move(spark, day, f"{path.rstrip('/')}/{name}")
        delete(spark, staged)


def _stage(path: str) -> str:
    return f"{path.rstrip('/')}__staged"


def _touched(spark: SparkSession, path: str, incoming: DataFrame) -> DataFrame | None:
    """Gold rows of the days in the batch, if there are any: only the folders of
    these days are listed and read. The calendar bounds their number."""
    days = [row[DAY] for row in incoming.select(DAY).distinct().collect()]
    folders = [f"{path.rstrip('/')}/{DAY}={day.isoformat()}" for day in sorted(days)]
    there = [folder for folder in folders if exists(spark, folder)]
    if not there:
        return None
    return spark.read.option("basePath", path).parquet(*there).drop(STAMP)


def upsert_connector(rows: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """A key table whose append is an upsert (key-value connectors). One row per
    key is sent, so the order of writes does not matter."""
    latest_per_key(rows).select(
        *[c for c in rows.columns if c not in V.ARRIVAL]
    ).write.format(fmt).mode("append").options(**options).save()


def newest_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """(date, newest) of gold, newest in microseconds, from the footers of its files."""
    return read_footers(spark, path).groupBy(DAY).agg(F.max(STAMP).alias("newest"))


def _scanned_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """The same by reading the column, null for a day without arrivals."""
    return spark.read.parquet(path).groupBy(DAY).agg(
        F.max(F.unix_micros("ingestion_timestamp")).alias("newest")
    )


def expire_gold(spark: SparkSession, path: str, as_of, days: int = V.RETENTION_DAYS) -> int:
    """Storage side of retention: deletes the day partitions in which no row is
    left to keep. Returns their number. Younger days are handled on read. A swap
    left open is completed first, or it would bring an expired day back.

    No column is read but in a table that has files of a writer without the stamp.
    """
    finish_swap(spark, path)
    limit = F.unix_micros(F.lit(as_of) - F.make_interval(days=F.lit(days)))
    stale = (F.col("newest") < limit) & (F.col("newest") != NO_STAMP)

    def found(newest: DataFrame) -> list:
        return [row[DAY] for row in newest.filter(stale).select(DAY).collect()]  # one value per day

    if STAMP in spark.read.parquet(path).columns:
        try:
            gone = found(newest_arrivals(spark, path))
        except Py4JJavaError:  # a file whose footer does not know the column
            gone = found(_scanned_arrivals(spark, path))
    else:
        gone = found(_scanned_arrivals(spark, path))
    for day in gone:
        delete(spark, f"{path.rstrip('/')}/{DAY}={day.isoformat()}")
    return len(gone)


def compact_days(spark: SparkSession, path: str, days: list, buckets: int | None = None) -> None:
    """Rewrites the given days of gold into evenly sized files."""
    finish_swap(spark, path)
    replace_days(read_gold(spark, path).filter(F.col(DAY).isin(list(days))).drop(DAY), path, buckets)


def compact_silver(spark: SparkSession, path: str, days: list) -> None:
    """Puts the batch folders of the given days of silver into one folder per day.

    The newest batch can come again after a restart and then replaces its own folder,
    so a day it wrote to is refused. A sync stream reads the rewritten files once more,
    which the upsert makes harmless; it should be past these days, as files it has
    planned to read go.
    """
    _compact_batches(spark, path, days, lambda rows: rows)


def compact_partials(spark: SparkSession, path: str, days: list) -> None:
    """Merges the partial sums of the given event days into a row per zone. A day with
    sums of the newest batch, which can come again, is refused; a later event of a
    merged day adds its own."""
    _compact_batches(spark, path, days, merge_partials)


def _compact_batches(spark: SparkSession, path: str, days: list, merge) -> None:
    finish_swap(spark, path)
    table = spark.read.parquet(path)
    newest = table.agg(F.max(BATCH)).first()[0]
    rows = table.filter(F.col(DAY).isin(list(days)))
    if not rows.filter(F.col(BATCH) == newest).isEmpty():
        raise ValueError("the newest batch wrote to one of these days")
    last = rows.groupBy(DAY).agg(F.max(BATCH).alias(BATCH))  # one row per day
    (
        merge(rows.drop(BATCH)).join(F.broadcast(last), DAY).hint("rebalance", DAY)
        .write.partitionBy(DAY, BATCH).parquet(f"{_stage(path)}/{uuid.uuid4().hex}")
    )
    finish_swap(spark, path)
