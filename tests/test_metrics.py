import numpy as np
import pytest

from wattlake.operators.metrics import regression_metrics, residuals


def scored(spark, rows):
    return spark.createDataFrame(rows, "split string, y double, prediction double")


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(50, 10, 200)
    p = y + rng.normal(0, 3, 200)
    rows = [("train" if i < 150 else "test", float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    for r in regression_metrics(scored(spark, rows), "y").collect():
        a = np.array([x[1] for x in rows if x[0] == r.split])
        b = np.array([x[2] for x in rows if x[0] == r.split])
        assert r.n_rows == len(a)
        assert r.mae == pytest.approx(np.mean(np.abs(a - b)))
        assert r.rmse == pytest.approx(np.sqrt(np.mean((a - b) ** 2)))
        assert r.r2 == pytest.approx(1 - ((a - b) ** 2).sum() / ((a - a.mean()) ** 2).sum())
        assert r.mape == pytest.approx(100 * np.mean(np.abs((a - b) / a)))


def test_zero_actuals_are_counted_not_infinite(spark):
    r = regression_metrics(scored(spark, [("t", 0.0, 1.0), ("t", 0.0, 0.0), ("t", 2.0, 1.0)]), "y").first()
    assert (r.mape, r.n_zero_actual, r.n_rows) == (50.0, 2, 3)


def test_constant_actual_has_no_r2(spark):
    r = regression_metrics(scored(spark, [("t", 2.0, 1.0), ("t", 2.0, 3.0)]), "y").first()
    assert r.r2 is None and r.mae == 1.0


def test_residuals(spark):
    r = residuals(scored(spark, [("t", 5.0, 3.5)]), "y").first()
    assert (r.actual, r.predicted, r.residual) == (5.0, 3.5, 1.5)
