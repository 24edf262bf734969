import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_features import carbon, gold
from wattlake import vocabulary as V
from wattlake.operators.metrics import residuals
from wattlake.plans import consumption, forecast
from wattlake.sinks import models

REGIONS = ["DE", "FR", "MA"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    mix, gas = [], []
    for h in range(240):
        time = (dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).isoformat()
        for i, region in enumerate(REGIONS):
            made = 100.0 * (i + 1) + 5 * (h % 24) + rng.random()
            mix.append((region, time, {
                "total_production": made, "total_consumption": made * 0.9 + rng.random(),
                "nuclear": made / 2, "renewable_percentage": 40.0, "fossil_free_percentage": 60.0}))
            if region != "MA":
                gas.append((region, time, 50.0 + h % 24))
    return gold(spark, mix), carbon(spark, gas)


@pytest.fixture(scope="module")
def trained(tables):
    return consumption.train(*tables, trees=8)


def test_beats_the_mean(trained):
    metrics = {r.split: r for r in trained.metrics.collect()}
    assert metrics["train"].n_rows == 576 and metrics["test"].n_rows == 144
    spread = trained.scored.filter("split = 'test'").agg(F.stddev_pop(V.CONSUMPTION_LABEL)).first()[0]
    assert metrics["test"].rmse < spread
    assert residuals(trained.scored, V.CONSUMPTION_LABEL).count() == 720


def test_columns_and_importance(trained):
    assert "production_consumption_ratio" not in trained.columns and len(trained.columns) == 24
    rows = trained.importance.collect()
    assert [r.feature for r in rows] and len(rows) == 24
    weights = [r.importance for r in rows]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1.0)


def test_same_seed_same_model(tables, trained):
    again = consumption.train(*tables, trees=8)
    assert again.importance.collect() == trained.importance.collect()


def test_save_and_forecast(spark, tables, trained, folder):
    root = folder("models")
    consumption.export(trained, root, at("2024-02-01T00:00:00"))
    newest = consumption.export(trained, root, at("2024-02-02T00:00:00"))
    model, run = models.load_latest(spark, root)
    assert run["run_id"] == newest and run["n_features"] == 24
    assert run["features"] == trained.columns and run["train_rows"] == 576

    mix, gas = tables
    start = at("2024-01-11T05:00:00")
    hours = forecast.predict_next_hours(model, mix, gas, start, 6)
    assert hours.count() == 18
    assert {r.region for r in hours.collect()} == set(REGIONS)
    one = forecast.predict_consumption(model, mix, gas, "MA", start, newest).collect()
    same = hours.filter((F.col("region") == "MA") & (F.col("datetime") == F.lit(start))).first()
    assert len(one) == 1
    assert one[0].predicted_consumption == same.predicted_consumption
    assert one[0].predicted_consumption == round(one[0].predicted_consumption, 2)
    assert one[0].features.hour == 5 and one[0].features.carbon_intensity == 0.0
    assert forecast.predict_consumption(model, mix, gas, "XX", start).count() == 0

    ranked = forecast.compare_regions(model, mix, gas, ["MA", "DE", "XX"], start).collect()
    assert [r.region for r in ranked] == ["MA", "DE"]
    assert ranked[0].predicted_consumption >= ranked[1].predicted_consumption


def test_unseen_region_is_an_error(trained, spark, tables):
    stranger = gold(spark, [("ZZ", "2024-01-11T00:00:00", {"total_production": 1.0})])
    rows = forecast.predict_next_hours(trained.model, stranger, tables[1], at("2024-01-11T05:00:00"), 1)
    with pytest.raises(Exception, match="Unseen label: ZZ"):
        rows.select("prediction").collect()


def test_no_model_yet(spark, tmp_path, trained, folder):
    root = folder("models")
    consumption.export(trained, root, at("2024-02-01T00:00:00"))
    with pytest.raises(FileNotFoundError):
        models.load_latest(spark, root, "another_label")


def test_carbon_label(tables):
    model = consumption.train(*tables, label=V.CARBON_LABEL, trees=3)
    assert V.CARBON_LABEL not in model.columns
    # rows without a reading cannot be learnt from
    assert sum(r.n_rows for r in model.metrics.collect()) == 480


@pytest.mark.parametrize("regions", [40, 400])
def test_any_number_of_regions(spark, regions, folder):
    rows = [(f"R{r:03}", (dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).isoformat(),
             {"total_production": 10.0 * r + h, "total_consumption": 9.0 * r + h})
            for r in range(regions) for h in range(6)]
    mix, gas = gold(spark, rows), carbon(spark, [("R000", "2024-01-01T00:00:00", 50.0)])
    trained = consumption.train(mix, gas, trees=2)
    root = folder("models")
    consumption.export(trained, root, at("2024-01-02T00:00:00"))
    model, _ = models.load_latest(spark, root)
    rows = forecast.predict_next_hours(model, mix, gas, at("2024-01-02T00:00:00"), 2).collect()
    assert len(rows) == 2 * regions and all(r.predicted_consumption is not None for r in rows)


def tasks_of_levels(spark, group):
    """Tasks of each stage in which a level of a tree is counted."""
    seen = spark.sparkContext.statusTracker()
    stages = [seen.getStageInfo(k) for j in seen.getJobIdsForGroup(group) for k in seen.getJobInfo(j).stageIds]
    return [s.numTasks for s in stages if s is not None and "RandomForest" in s.name]


def test_rows_are_dealt_by_their_number(spark, tables):
    """Not by the shuffle's partitions or files: every one would be a task 1,800 times."""
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        spark.sparkContext.setJobGroup("learning", "trees")
        found = consumption.train(*tables, trees=2)
        spark.sparkContext.setJobGroup("learnt", "")
        assert {r.split: r.n_rows for r in found.metrics.collect()} == {"train": 576, "test": 144}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    tasks = tasks_of_levels(spark, "learning")
    assert tasks and max(tasks) == 1


@pytest.mark.parametrize("rows, cores, tasks", [
    (0, 12, 1), (1, 12, 1), (8_192, 12, 1), (8_193, 12, 2), (432_000, 12, 12), (2_592_000, 12, 12),
    (12_000_000, 12, 12), (12_000_001, 12, 13), (10**9, 12, 1000),
])
def test_tasks_of_a_level(rows, cores, tasks):
    assert consumption.learning_tasks(rows, cores) == tasks
