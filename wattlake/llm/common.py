"""What the corpus operators share."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.sources.scratch import materialize, new_path

#: White space of the contracts; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back."""
    return materialize(df, new_path(df.sparkSession, name))


def store_dealt(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """As ``store``, dealt by ``keys`` into as many buckets as a shuffle has partitions: a
    join on just these keys moves the other side only."""
    spark, buckets = df.sparkSession, partitions(df.sparkSession)
    # Files are told their bucket only when written as a table; the entry goes again, the
    # files and what was read from the entry stay.
    entry = f"dealt_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
        .option("path", new_path(spark, name)).saveAsTable(entry)
    )
    dealt = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return dealt


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))
