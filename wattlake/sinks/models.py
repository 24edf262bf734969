"""Run records, importances and saved models."""

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def run_record(
    metrics: DataFrame, run_id: str, trained_on: dt.datetime, model_path: str,
    label: str, features: list[str],
) -> DataFrame:
    """One row per run: sizes and test metrics, model path, feature names."""
    def of(split, column):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    return metrics.agg(
        of("train", "n_rows").alias("train_rows"),
        of("test", "n_rows").alias("test_rows"),
        *[of("test", m).alias(m) for m in ("mae", "rmse", "r2", "mape", "n_zero_actual")],
    ).select(
        F.lit(run_id).alias("run_id"),
        F.lit(trained_on).alias("trained_on"),
        F.lit(label).alias("label"),
        F.lit(model_path).alias("model_path"),
        "train_rows", "test_rows",
        F.lit(len(features)).alias("n_features"),
        "mae", "rmse", "r2", "mape", "n_zero_actual",
        F.array(*[F.lit(f) for f in features]).alias("features"),
    )


def runs_path(root: str) -> str:
    return f"{root.rstrip('/')}/model_runs"


def save_run(root: str, model: PipelineModel, record: DataFrame, importance: DataFrame,
             run_id: str) -> None:
    """Model first, record last: a run is visible only when all of it is there."""
    base = root.rstrip("/")
    model.write().save(f"{base}/models/{run_id}")
    importance.coalesce(1).write.option("header", True).csv(f"{base}/importance/{run_id}")
    record.write.mode("append").parquet(runs_path(base))


def model_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/models/{run_id}"


def latest_run(spark: SparkSession, root: str, label: str | None = None) -> DataFrame:
    """The newest run, of a label if given: one row or none."""
    runs = spark.read.parquet(runs_path(root))
    if label is not None:
        runs = runs.filter(F.col("label") == label)
    return runs.orderBy(F.desc("trained_on"), F.desc("run_id")).limit(1)


def load_latest(spark: SparkSession, root: str, label: str | None = None):
    """The newest model and its run row."""
    run = latest_run(spark, root, label).first()
    if run is None:
        raise FileNotFoundError(f"no trained model under {root}")
    return PipelineModel.load(run["model_path"]), run
