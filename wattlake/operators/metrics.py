"""Regression quality in one aggregation."""

from pyspark.sql import DataFrame, functions as F


def regression_metrics(
    scored: DataFrame, label: str, prediction: str = "prediction", by: str = "split"
) -> DataFrame:
    """MAE, RMSE, R2 and MAPE per group.

    Actual values of 0 have no percentage error: they are left out of the MAPE
    and counted in ``n_zero_actual``. A constant actual has no R2 (null).
    """
    actual, error = F.col(label), F.col(label) - F.col(prediction)
    return (
        scored.groupBy(by)
        .agg(
            F.count("*").alias("n_rows"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.sum(error * error).alias("squared_error"),
            (F.var_pop(actual) * F.count(actual)).alias("squared_spread"),
            (100 * F.avg(F.abs(F.try_divide(error, actual)))).alias("mape"),
            F.count_if(actual == 0).alias("n_zero_actual"),
        )
        .withColumn("r2", 1 - F.try_divide(F.col("squared_error"), F.col("squared_spread")))
        .select(by, "n_rows", "mae", "rmse", "r2", "mape", "n_zero_actual")
    )


def residuals(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Actual, predicted and their difference, for plots."""
    keys = [c for c in ("region", "timestamp", "split") if c in scored.columns]
    return scored.select(
        *keys,
        F.col(label).alias("actual"),
        F.col(prediction).alias("predicted"),
        (F.col(label) - F.col(prediction)).alias("residual"),
    )
