"""Run parameters as a plain dataclass (the reference reads them from YAML)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # chronological split edges, both inclusive
    train_end: str = "1999-12-31"
    val_end: str = "2000-12-31"
    # feature families
    lags: tuple[int, ...] = (1, 2, 4, 52)
    rolling_windows: tuple[int, ...] = (4, 8)
    exogenous: tuple[str, ...] = ("markdown_total", "fuel_price", "temperature")
    negative_sales_strategy: str = "clip"
    # evaluation
    holiday_weight: float = 5.0
    mape_threshold: float = 1.0
    # baselines
    moving_average_window: int = 4
    seasonal_k: int = 3
    # eda
    cold_start_weeks: int = 26
    top_stores: int = 10
    top_depts: int = 15
    top_segment_depts: int = 10
    holiday_hist_bins: int = 50
    series_hist_bins: int = 30
    # model gate / ensembles
    gate_model: str = "Seasonal Naive"
    ridge_folds: int = 5
    # forecast (week, year) pairs are broadcast up to this many, joined by sort-merge beyond
    max_forecast_dates: int = 10_000
    # boosting: rounds at most, and rounds without a better validation error before stopping
    boosting_rounds: int = 1_000
    boosting_patience: int = 50


DEFAULT = Params()
