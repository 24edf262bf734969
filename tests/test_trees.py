"""The exported trees, evaluated and weighed again in plain Python."""

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_features import carbon, gold
from tests.test_model import tables, trained  # noqa: F401
from wattlake.plans import consumption, forecast


@pytest.fixture(scope="module")
def exported(spark, trained, tmp_path_factory):  # noqa: F811
    """Nodes of every tree by id, and the weights of the trees, as the model is saved."""
    path = str(tmp_path_factory.mktemp("model") / "trees")
    trained.model.stages[-1].save(path)
    trees = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    return trees, weights


def evaluate(exported, values):
    trees, weights = exported
    total = 0.0
    for tree, nodes in trees.items():
        node = nodes[0]
        while node.leftChild >= 0:
            assert node.split.numCategories == -1  # a number, not a class
            left = values[node.split.featureIndex] <= node.split.leftCategoriesOrThreshold[0]
            node = nodes[node.leftChild if left else node.rightChild]
        total += weights[tree] * node.prediction
    return total


def test_every_prediction_is_that_of_the_trees(trained, exported, tables):  # noqa: F811
    rows = forecast.predict_next_hours(trained.model, *tables, at("2024-01-09T00:00:00"), 24)
    found = rows.select(vector_to_array("features").alias("x"), "prediction", "predicted_consumption").collect()
    assert len(found) == 72
    for row in found:
        own = evaluate(exported, row.x)
        assert row.prediction == pytest.approx(own, rel=1e-12)
        assert row.predicted_consumption == pytest.approx(round(own, 2), abs=0.0100001)
    assert len({r.prediction for r in found}) > 10


def test_importance_is_the_share_of_gain(trained, exported):  # noqa: F811
    gains = [0.0] * len(trained.columns)
    for nodes in exported[0].values():
        for node in nodes.values():
            if node.leftChild >= 0:
                gains[node.split.featureIndex] += node.gain * node.impurityStats[0]
    expected = {name: g / sum(gains) for name, g in zip(trained.columns, gains)}
    got = {r.feature: r.importance for r in trained.importance.collect()}
    assert got == pytest.approx(expected, rel=1e-9, abs=1e-12)


def test_metrics_of_the_scored_rows(trained):  # noqa: F811
    rows = trained.scored.filter("split = 'test'").collect()
    errors = [r.total_consumption - r.prediction for r in rows]
    mean = sum(r.total_consumption for r in rows) / len(rows)
    m = trained.metrics.filter("split = 'test'").first()
    assert m.mae == pytest.approx(sum(map(abs, errors)) / len(rows))
    assert m.rmse == pytest.approx((sum(e * e for e in errors) / len(rows)) ** 0.5)
    assert m.r2 == pytest.approx(1 - sum(e * e for e in errors) / sum((r.total_consumption - mean) ** 2 for r in rows))


def four_regions(spark, used):
    mix, gas = [], []
    for h in range(60):
        time = (dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).isoformat()
        for region in ("MA", "FR", "ES", "DE"):
            mix.append((region, time, {"total_production": 10.0, "total_consumption": used(region)}))
            gas.append((region, time, 50.0))
    return gold(spark, mix), carbon(spark, gas)


def test_regions_by_prediction_then_by_name(spark):
    when = at("2024-01-04T10:00:00")
    tied = four_regions(spark, lambda region: 7.0)
    model = consumption.train(*tied, trees=2).model
    rows = forecast.compare_regions(model, *tied, None, when).collect()
    assert [r.region for r in rows] == ["DE", "ES", "FR", "MA"]
    assert {r.predicted_consumption for r in rows} == {7.0}
    apart = four_regions(spark, {"MA": 40.0, "FR": 10.0, "ES": 40.0, "DE": 90.0}.get)
    model = consumption.train(*apart, trees=30).model
    rows = forecast.compare_regions(model, *apart, None, when).collect()
    assert [r.region for r in rows] == ["DE", "ES", "MA", "FR"]
    some = forecast.compare_regions(model, *apart, ["FR", "DE"], when).collect()
    assert [r.region for r in some] == ["DE", "FR"]


def test_rounding_halves_to_even(spark):
    """The rounding of predictions: as numbers stand in binary, halves to the even side."""
    rows = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (-0.125,), (1.005,)], "x double")
    assert [r[0] for r in rows.select(F.bround("x", 2)).collect()] == [0.12, 0.38, 2.5, -0.12, 1.0]
