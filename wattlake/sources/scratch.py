"""Shared folder for tables a job writes between its steps."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; in local mode one of our own if none is named.

    Executors can be lost, so nothing goes to a folder only one machine sees.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="wattlake-")
    return _own[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative learners cut their lineage there."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/rdd")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wattlake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Writes the rows once and reads them back: later steps start from the
    files, with column pruning and pushed filters, also after a lost executor."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
