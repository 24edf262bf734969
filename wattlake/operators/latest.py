"""Last write wins per key, latest row per region, retention, marks."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlake import vocabulary as V

DAY = "date"  # partition column of stored tables
WRITE_ORDER = ["ingestion_timestamp", "arrival_offset", "arrival_partition"]


def latest_per_key(rows: DataFrame) -> DataFrame:
    """Gold: of all arrivals for a (region, timestamp) the last one.

    Spark limits each key to its first row before the exchange too, so a key that
    holds a large share of the rows sends one row per task, whatever its size.
    """
    last_first = Window.partitionBy(*V.KEY).orderBy(*[F.desc(c) for c in WRITE_ORDER])
    numbered = rows.select("*", F.row_number().over(last_first).alias("_rank"))
    return numbered.filter(F.col("_rank") == 1).select(*rows.columns)


def latest_by_region(gold: DataFrame) -> DataFrame:
    """The newest row of every region; gold has one row per region and time.

    The newest times come from two columns; only the days in which they lie are
    then read in full, and no row is sorted.
    """
    newest = gold.groupBy("region").agg(F.max("timestamp").alias("timestamp"))
    keys = [*V.KEY]
    if DAY in gold.columns:
        newest = newest.withColumn(DAY, F.to_date("timestamp"))
        keys.append(DAY)
    return gold.join(newest, keys).select(*gold.columns)


def retained(
    gold: DataFrame, as_of: Column | dt.datetime, days: int = V.RETENTION_DAYS
) -> DataFrame:
    """Rows written within ``days`` before ``as_of``."""
    oldest = F.lit(as_of) - F.make_interval(days=F.lit(days))
    return gold.filter(F.col("ingestion_timestamp") >= oldest)


def newer_than(rows: DataFrame, mark: dt.datetime | Column | None,
               column: str = "processing_time", stored_by: str | None = None) -> DataFrame:
    """Rows strictly above the mark, all of them when there is none. ``stored_by``
    names the time column whose day the table is partitioned by."""
    if mark is None:
        return rows
    return _days_from(rows, mark, column, stored_by).filter(F.col(column) > F.lit(mark))


def since(rows: DataFrame, start: dt.datetime | Column, column: str,
          stored_by: str | None = None) -> DataFrame:
    """Rows from ``start`` on."""
    return _days_from(rows, start, column, stored_by).filter(F.col(column) >= F.lit(start))


def _days_from(rows: DataFrame, start: dt.datetime | Column, column: str,
               stored_by: str | None) -> DataFrame:
    """A table stored by the day of this very column skips the days before; the day
    of another column says nothing."""
    if stored_by != column:
        return rows
    return rows.filter(F.col(DAY) >= F.to_date(F.lit(start)))


def high_water_mark(rows: DataFrame, column: str = "processing_time") -> dt.datetime | None:
    """Runs one aggregation; the result is one value, in UTC."""
    micros = rows.agg(F.unix_micros(F.max(column)).alias("mark")).first()["mark"]
    return None if micros is None else utc_instant(micros)


def utc_instant(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


def for_regions(df: DataFrame, regions: list[str]) -> DataFrame:
    return df.filter(F.col("region").isin(list(regions)))
