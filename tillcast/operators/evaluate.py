"""Scoring forecasts against actuals.

One inner join of actuals to (long) predictions on the three keys, then one
group-by per report.  Segment reports stack the segment columns into
(segment_type, segment) so all segment families share that single join and a
single aggregation instead of one merge per family.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import DEFAULT, Params
from tillcast.functions.metrics import metric_columns
from tillcast.schemas import KEYS


def scored_pairs(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """C4: inner join on the three keys (series without a forecast drop out)."""
    return actual.join(predicted, KEYS, "inner")


def evaluate_predictions(actual: DataFrame, predicted: DataFrame, by=(), with_wmae: bool = False,
                         params: Params = DEFAULT) -> DataFrame:
    """I11 (with_wmae False) / I12 (True); ``by`` = e.g. ['model'] for many forecasts at once."""
    m = scored_pairs(actual, predicted)
    cols = metric_columns(with_wmae, params.holiday_weight, params.mape_threshold)
    return m.groupBy(*by).agg(*cols) if by else m.agg(*cols)


def evaluate_by_segments(actual: DataFrame, predicted: DataFrame, segment_cols, by=(),
                         params: Params = DEFAULT) -> DataFrame:
    """Metrics per (by..., segment_type, segment); null segments dropped.
    Raises if a segment column is absent (as the reference does)."""
    m = scored_pairs(actual, predicted)
    missing = [c for c in segment_cols if c not in m.columns]
    if missing:
        raise ValueError(f"no such segment column: {', '.join(missing)}")
    seg = F.explode(F.array(*[F.struct(F.lit(c).alias("segment_type"), F.col(c).cast("string").alias("segment"))
                              for c in segment_cols]))
    s = m.select("*", seg.alias("_s")).select("*", "_s.segment_type", "_s.segment").drop("_s")
    s = s.where(F.col("segment").isNotNull())
    cols = metric_columns(True, params.holiday_weight, params.mape_threshold)
    return s.groupBy(*by, "segment_type", "segment").agg(*cols)


def best_by(metrics: DataFrame, metric: str, name_col: str = "model") -> DataFrame:
    """argmin of a metric (name as tie-break), one row."""
    return metrics.agg(F.min_by(F.col(name_col), F.struct(F.col(metric), F.col(name_col))).alias(f"best_{metric}"))


def evaluation_report(test_metrics: DataFrame, val_metrics: DataFrame | None = None) -> DataFrame:
    """I16: models sorted by test RMSE with test metrics, then C10 left join of validation
    RMSE / WMAE by model name."""
    r = test_metrics.select(
        F.col("model").alias("model_name"),
        *[F.round(c, 4).alias(f"test_{c}") for c in ("rmse", "mae", "wmae", "mape", "r_squared")],
        "n_samples")
    if val_metrics is not None:
        v = val_metrics.select(F.col("model").alias("model_name"), F.col("rmse").alias("val_rmse"),
                               F.col("wmae").alias("val_wmae"))
        r = r.join(v, "model_name", "left")
    return r.orderBy("test_rmse", "model_name")


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Pairs of one model with the axis maximum greatest(max(a), max(p))."""
    m = scored_pairs(actual, predicted).select(*KEYS, F.col("weekly_sales").cast("double").alias("actual"),
                                               "predicted_sales")
    top = m.agg(F.greatest(F.max("actual"), F.max("predicted_sales")).alias("axis_max"))
    return m.select("*", top.select("axis_max").scalar().alias("axis_max"))


def pick_predictions(long_predictions: DataFrame, preferred: str) -> DataFrame:
    """Predictions of ``preferred`` if it has any, else those of the first model by name."""
    names = long_predictions.groupBy("model").agg(F.count(F.lit(1)).alias("_n"))
    chosen = names.agg(F.coalesce(F.max(F.when(F.col("model") == preferred, F.col("model"))),
                                  F.min("model")).alias("_chosen"))
    return long_predictions.where(F.col("model") == chosen.select("_chosen").scalar())


def series_key_summary(df: DataFrame, store_id: int, dept_id: int) -> DataFrame:
    """Row count and first / last date of one series (filter pushed to the scan)."""
    s = df.where((F.col("store_id") == store_id) & (F.col("dept_id") == dept_id))
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.min("week_date").alias("first_date"),
                 F.max("week_date").alias("last_date"))


def compare_forecasts(actual: DataFrame, forecasts: dict[str, DataFrame]) -> DataFrame:
    """Actuals beside several forecasts, joined by key (not position), with errors."""
    out = actual.select(*KEYS, F.col("weekly_sales").cast("double").alias("actual"))
    for name, p in forecasts.items():
        out = out.join(p.select(*KEYS, F.col("predicted_sales").alias(f"pred_{name}")), KEYS, "left")
        out = out.withColumn(f"err_{name}", F.col("actual") - F.col(f"pred_{name}"))
    return out


def error_summary(comparison: DataFrame, names) -> DataFrame:
    """Mean and sample std of the signed error per forecast."""
    aggs = []
    for n in names:
        aggs += [F.avg(f"err_{n}").alias(f"mean_err_{n}"), F.stddev_samp(f"err_{n}").alias(f"std_err_{n}")]
    return comparison.agg(*aggs)


def tail_rows(df: DataFrame, n: int, order_col: str = "week_date") -> DataFrame:
    """last n rows by date (top-k: each task keeps n rows, the driver merges them)."""
    return df.orderBy(F.desc(order_col)).limit(n)
