import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from wattlake import vocabulary as V
from wattlake.operators import features as ft
from wattlake.sources.scratch import materialize

GOLD = (
    "region string, timestamp timestamp, "
    + ", ".join(f"{c} double" for c in V.GOLD_MIX_COLUMNS[2:-2])
    + ", ingestion_timestamp timestamp, ingestion_id string"
)
CARBON = "region string, timestamp timestamp, carbon_intensity double, is_estimated boolean"


def gold(spark, rows):
    """Rows of (region, time, {column: value})."""
    numbers = V.GOLD_MIX_COLUMNS[2:-2]
    return spark.createDataFrame(
        [(r, at(t), *[v.get(c) for c in numbers], at(t), "id") for r, t, v in rows], GOLD
    )


def carbon(spark, rows):
    return spark.createDataFrame([(r, at(t), v, False) for r, t, v in rows], CARBON)


@pytest.mark.parametrize("time, monday_first, sunday_first, weekend, peak", [
    ("2024-01-05T23:00:00", 4, 6, 0, 0),
    ("2024-01-06T07:59:59", 5, 7, 1, 0),
    ("2024-01-06T08:00:00", 5, 7, 1, 1),
    ("2024-01-07T10:59:00", 6, 1, 1, 1),
    ("2024-01-07T11:00:00", 6, 1, 1, 0),
    ("2024-01-08T00:00:00", 0, 2, 0, 0),
    ("2024-01-08T17:00:00", 0, 2, 0, 0),
    ("2024-01-08T18:00:00", 0, 2, 0, 1),
    ("2024-01-08T20:59:00", 0, 2, 0, 1),
    ("2024-01-08T21:00:00", 0, 2, 0, 0),
])
def test_calendar(spark, time, monday_first, sunday_first, weekend, peak):
    rows = gold(spark, [("FR", time, {"total_consumption": 1.0})])
    joined = ft.mix_with_carbon(rows, carbon(spark, []))
    f = ft.features(joined).first()
    assert (f.day_of_week, f.is_weekend, f.is_peak_hour) == (monday_first, weekend, peak)
    s = ft.short_features(joined).first()
    assert (s.day_of_week, s.is_weekend) == (sunday_first, weekend)


def test_ratios(spark):
    t = "2024-01-06T00:00:00"
    rows = ft.features(ft.mix_with_carbon(gold(spark, [
        ("A", t, {"total_production": 10.0, "total_consumption": -1.0,
                  "renewable_percentage": 25.0, "fossil_free_percentage": 40.0}),
        ("B", t, {"total_production": 10.0, "total_consumption": 4.0}),
        ("C", t, {"total_production": 10.0}),
    ]), carbon(spark, []))).orderBy("region").collect()
    assert [r.production_consumption_ratio for r in rows] == [None, 2.0, None]
    assert (rows[0].renewable_ratio, rows[0].fossil_ratio) == (0.25, 0.6)
    assert rows[1].renewable_ratio is None


def test_join_keeps_mix_rows_without_carbon(spark):
    t = "2024-01-06T00:00:00"
    joined = ft.mix_with_carbon(
        gold(spark, [("A", t, {}), ("B", t, {})]), carbon(spark, [("B", t, 5.0), ("C", t, 6.0)])
    ).orderBy("region").collect()
    assert [(r.region, r.carbon_intensity) for r in joined] == [("A", None), ("B", 5.0)]


def test_training_rows(spark):
    t = "2024-01-06T00:00:00"
    featured = ft.features(ft.mix_with_carbon(gold(spark, [
        ("SE", t, {"total_consumption": 3.0}), ("CA-ON", t, {"total_consumption": 2.0}),
        ("FR", t, {}), ("DE", t, {"total_consumption": float("nan")}),
    ]), carbon(spark, [])))
    rows = ft.training_set(featured, leaky=True).orderBy("region").collect()
    # a row without label is out, codes follow the remaining regions in sorted order
    assert [(r.region, r.region_encoded) for r in rows] == [("CA-ON", 0), ("SE", 1)]
    assert all(v is not None for r in rows for v in r)
    assert ft.training_set(featured, leaky=True).columns == (
        V.KEY + V.FEATURES + [V.CONSUMPTION_LABEL])
    assert "production_consumption_ratio" not in ft.training_set(featured).columns
    assert len(V.FEATURES) == 25


def test_missing_columns_are_reported():
    class Frame:
        columns = ["hour", "wind"]

    assert ft.available(Frame, ["wind", "oil", "hour"]) == (["wind", "hour"], ["oil"])


def test_snapshot(spark):
    mix = gold(spark, [
        ("A", "2024-01-06T01:00:00", {"total_production": 1.0}),
        ("A", "2024-01-06T02:00:00", {"total_production": 2.0}),
        ("B", "2024-01-06T01:00:00", {"total_consumption": -1.0}),
    ])
    gas = carbon(spark, [("A", "2024-01-05T00:00:00", 7.0), ("A", "2024-01-06T00:00:00", 8.0),
                         ("Z", "2024-01-06T00:00:00", 9.0)])
    rows = ft.latest_snapshot(mix, gas).orderBy("region").collect()
    assert [(r.region, r.total_production, r.carbon_intensity) for r in rows] == [
        ("A", 2.0, 8.0), ("B", 0.0, 0.0)]
    assert rows[1].production_consumption_ratio is None


def test_forecast_grid(spark):
    snapshot = ft.latest_snapshot(
        gold(spark, [("A", "2024-01-06T01:00:00", {}), ("B", "2024-01-06T01:00:00", {})]),
        carbon(spark, []))
    grid = ft.forecast_grid(snapshot, at("2024-01-06T22:30:00"), 6)
    assert grid.count() == 12
    hours = [r.hour for r in grid.filter("region = 'A'").orderBy("datetime").collect()]
    assert hours == [22, 23, 0, 1, 2, 3]
    assert grid.agg(F.max("datetime").alias("m")).first().m == dt.datetime(2024, 1, 7, 3, 30)
    assert ft.forecast_grid(snapshot, at("2024-01-06T22:30:00"), 1).count() == 2


def test_join_plan_reads_only_the_columns_it_needs(spark, folder):
    rows = [("A", "2024-01-06T00:00:00", {"total_consumption": 1.0})]
    mix = materialize(gold(spark, rows), folder("m"))
    gas = materialize(carbon(spark, [("A", "2024-01-06T00:00:00", 5.0)]), folder("c"))
    joined = ft.mix_with_carbon(mix, gas).groupBy("region").agg(F.avg("carbon_intensity"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<region:string,timestamp:timestamp,carbon_intensity:double>" in plan
    assert "nuclear" not in plan
