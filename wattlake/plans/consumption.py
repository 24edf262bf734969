"""Train, evaluate, explain, export a gradient-boosted model on gold."""

import datetime as dt
import math
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlake import vocabulary as V
from wattlake.operators.features import (
    available, clean_rows, features, mix_with_carbon, model_columns,
)
from wattlake.operators.history import History, with_history
from wattlake.operators.metrics import regression_metrics
from wattlake.operators.split import temporal_cut, temporal_split
from wattlake.sinks.models import model_path, run_record, save_run
from wattlake.sources.files import delete
from wattlake.sources.scratch import ensure_checkpoint_dir, materialize, new_path

# fixed values of the learner
TREES = 300
DEPTH = 6
RATE = 0.05
ROW_SHARE = 0.8
COLUMN_SHARE = "0.8"
SEED = 42

#: Training rows worth a task of their own. A level of a tree is a Spark job over all rows,
#: 1,800 jobs a model: with fewer rows a task costs more to start than it saves.
ROWS_A_TASK = 8_192
#: Training rows that a task may hold in memory, about 200 MB.
MOST_ROWS_A_TASK = 1_000_000


@dataclass
class TrainedModel:
    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame
    importance: DataFrame
    columns: list[str]
    label: str


def region_indexer() -> StringIndexer:
    """Codes in sorted order; a region that was not there is an error."""
    return StringIndexer(
        inputCol="region", outputCol="region_code", stringOrderType="alphabetAsc",
        handleInvalid="error",
    )


def plain_code() -> SQLTransformer:
    """The code as a number like any other: a nominal feature would need a bin per
    region, and training would fail beyond 32 regions."""
    return SQLTransformer(
        statement="SELECT *, CAST(region_code + 0 AS DOUBLE) AS region_encoded FROM __THIS__"
    )


def estimator(region_codes, columns: list[str], label: str, trees: int = TREES) -> Pipeline:
    """Region code, feature vector and trees in one saved object."""
    return Pipeline(stages=[
        region_codes,
        plain_code(),
        VectorAssembler(inputCols=columns, outputCol="features"),
        GBTRegressor(
            labelCol=label, featuresCol="features", predictionCol="prediction", lossType="squared",
            maxIter=trees, maxDepth=DEPTH, stepSize=RATE, subsamplingRate=ROW_SHARE,
            featureSubsetStrategy=COLUMN_SHARE, seed=SEED, checkpointInterval=10,
        ),
    ])


def importance_table(spark: SparkSession, model: PipelineModel, columns: list[str]) -> DataFrame:
    """Feature and importance, largest first; one row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(columns, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def learning_tasks(rows: int, cores: int) -> int:
    """Into how many tasks the rows are dealt: one wave over the cores, fewer if the rows
    are few, more only where a task would hold too many."""
    return max(min(math.ceil(rows / ROWS_A_TASK), cores), math.ceil(rows / MOST_ROWS_A_TASK), 1)


def train(
    mix: DataFrame, carbon: DataFrame, label: str = V.CONSUMPTION_LABEL, leaky: bool = False,
    trees: int = TREES, test_fraction: float = 0.2, extra: tuple[str, ...] = (),
) -> TrainedModel:
    """Fits on the earlier part of the rows, scores all of them. Regions are coded
    over both parts.

    The cleaned rows are written once: the split, the region index and every
    tree level read them again. They are written in key order, because row
    sampling goes by position and the seed alone would not repeat a model. They are dealt
    by their number, not by the size of files: the tasks of a level do not grow with the
    table beyond the cores. ``extra`` names further columns of the mix to learn from.
    """
    spark = mix.sparkSession
    ensure_checkpoint_dir(spark)
    cleaned = clean_rows(features(mix_with_carbon(mix, carbon)), label)
    columns, _ = available(cleaned.withColumn("region_encoded", F.lit(0)),
                           model_columns(label, leaky))
    cleaned, columns = cleaned.fillna(0, subset=list(extra)), columns + list(extra)
    inputs = [c for c in columns if c != "region_encoded"]
    # the same rows as in the training table, but still stored by day
    by_mix = label in mix.columns
    cut = temporal_cut(mix.dropna(subset=[label, *V.KEY]), test_fraction) if by_mix else None
    size = cut.train_rows + cut.test_rows if by_mix else mix.count()
    tasks = learning_tasks(size, spark.sparkContext.defaultParallelism)
    dealt = cleaned.select(*V.KEY, *inputs, label).repartition(tasks, *V.KEY)
    training = new_path(spark, "training")
    rows = materialize(dealt.sortWithinPartitions(*V.KEY), training)
    split = temporal_split(rows, cut or temporal_cut(rows, test_fraction))
    codes = region_indexer().fit(rows)
    learned = split.filter(F.col("split") == "train").coalesce(tasks)
    model = estimator(codes, columns, label, trees).fit(learned)
    scored = materialize(
        model.transform(split).select(*V.KEY, "split", label, "prediction"),
        new_path(spark, "scored"),
    )
    delete(spark, training)
    return TrainedModel(
        model, scored, regression_metrics(scored, label), importance_table(spark, model, columns),
        columns, label,
    )


def compare_history(
    mix: DataFrame, carbon: DataFrame, label: str = V.CONSUMPTION_LABEL, trees: int = TREES,
    history: History = History(),
) -> DataFrame:
    """Quality of two models on the same rows: with and without the label's own past."""
    path = new_path(mix.sparkSession, "history")
    longer = materialize(with_history(mix, label, history), path)
    variants = {"plain": train(longer, carbon, label, trees=trees),
                "history": train(longer, carbon, label, trees=trees, extra=tuple(history.columns(label)))}
    parts = [t.metrics.select(F.lit(name).alias("variant"), "*") for name, t in variants.items()]
    return parts[0].unionByName(parts[1])


def export(trained: TrainedModel, root: str, trained_on: dt.datetime) -> str:
    """Saves model, importances and run record; returns the run id."""
    run_id = uuid.uuid4().hex
    record = run_record(
        trained.metrics, run_id, trained_on, model_path(root, run_id), trained.label,
        trained.columns,
    )
    save_run(root, trained.model, record, trained.importance, run_id)
    return run_id
