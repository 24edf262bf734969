"""Raw landing area."""

from pyspark.sql import DataFrame, SparkSession


def list_objects(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """Landed objects, recursively; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "modificationTime", "length")
    )


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages, one per line, with the directory columns."""
    return spark.read.text(path)
