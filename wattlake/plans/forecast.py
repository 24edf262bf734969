"""Predictions from each region's last known state."""

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from wattlake.operators.asof import until
from wattlake.operators.features import forecast_grid, latest_snapshot
from wattlake.operators.latest import for_regions


def predict_next_hours(
    model: PipelineModel, mix: DataFrame, carbon: DataFrame, start: dt.datetime, hours: int = 24,
    regions: list[str] | None = None, name: str = "predicted_consumption",
) -> DataFrame:
    """Predictions for ``start`` and the hours after it, all regions in one pass, from the
    state that was known then: no row later than ``start`` is used.

    A region without gold rows up to then has no prediction; one the model has never
    seen is an error.
    """
    mix, carbon = until(mix, start), until(carbon, start)
    if regions is not None:
        mix, carbon = for_regions(mix, regions), for_regions(carbon, regions)
    grid = forecast_grid(latest_snapshot(mix, carbon), start, hours)
    return model.transform(grid).withColumn(name, F.bround("prediction", 2))


def predict_consumption(
    model: PipelineModel, mix: DataFrame, carbon: DataFrame, region: str, at: dt.datetime,
    model_name: str | None = None,
) -> DataFrame:
    """One row with the features used, or none."""
    row = predict_next_hours(model, mix, carbon, at, 1, [region])
    inputs = model.stages[-2].getInputCols()
    return row.select(
        "region", "datetime", "predicted_consumption",
        F.struct(*inputs).alias("features"), F.lit(model_name).alias("model"),
    )


def compare_regions(
    model: PipelineModel, mix: DataFrame, carbon: DataFrame, regions: list[str] | None, at: dt.datetime,
    name: str = "predicted_consumption",
) -> DataFrame:
    """Regions, all if none are named, by predicted value, highest first."""
    return (
        predict_next_hours(model, mix, carbon, at, 1, regions, name)
        .select("region", name)
        .orderBy(F.desc(name), "region")
    )
