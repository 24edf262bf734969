"""Folder operations on whatever file system the path names.

Spark has no public call for them: this module alone reaches for the gateway behind a
classic session, so these functions do not work over Spark Connect.
"""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Puts a folder in the place of another, which goes. Once moved it is no longer
    at its old place, so a repetition continues where it was broken off."""
    files, place = _at(spark, path)
    _, goal = _at(spark, target)
    files.delete(goal, True)
    files.mkdirs(goal.getParent())
    if not files.rename(place, goal):
        raise OSError(f"could not move {path} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    files, place = _at(spark, path)
    return [e.getPath().toString() for e in files.listStatus(place)] if files.exists(place) else []


def file_state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, modification time and length of every file below a path."""
    files, place = _at(spark, path)
    found, rest = [], files.listFiles(place, True)
    while rest.hasNext():
        entry = rest.next()
        found.append((entry.getPath().toString(), entry.getModificationTime(), entry.getLen()))
    return tuple(sorted(found))
