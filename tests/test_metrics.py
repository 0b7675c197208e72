"""Worked examples of the metric docstrings, and null handling."""

import pytest

from tillcast.functions.metrics import metric_columns


def frame(spark, rows):
    return spark.createDataFrame(rows, "weekly_sales double, predicted_sales double, isholiday boolean")


def test_goldens(spark):
    df = frame(spark, [(100.0, 110.0, False), (200.0, 190.0, True), (300.0, 310.0, False)])
    r = df.agg(*metric_columns(True, 5.0, 1.0)).first()
    assert r["rmse"] == pytest.approx(10.0)
    assert r["mae"] == pytest.approx(10.0)
    assert r["wmae"] == pytest.approx(10.0)
    assert r["mape"] == pytest.approx(6.111111, rel=1e-6)
    assert r["r_squared"] == pytest.approx(0.985)
    assert r["n_samples"] == 3


def test_mape_threshold_and_no_spread(spark):
    df = frame(spark, [(0.5, 1.0, None), (0.5, 2.0, None)])
    r = df.agg(*metric_columns(True, 5.0, 1.0)).first()
    assert r["mape"] is None          # no actual >= 1
    assert r["r_squared"] is None     # actuals have no spread
    assert r["wmae"] == pytest.approx(1.0)   # null holiday flag weighs 1


def test_null_pairs_skipped(spark):
    df = frame(spark, [(100.0, 110.0, False), (None, 5.0, False)])
    r = df.agg(*metric_columns(True, 5.0, 1.0)).first()
    assert r["rmse"] == pytest.approx(10.0)
    assert r["mae"] == pytest.approx(10.0)
