"""Ensembles and model selection (L12-L17) over long prediction frames.

Inputs are (model, keys, predicted_sales) and a metric frame with one row
per model.  Both combine by key with one group-by; the weight table has one
row per model, so joining it never grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.schemas import KEYS
from tillcast.session import broadcast_if_small


def gate_members(metrics: DataFrame, gate: str, name_col: str = "model") -> DataFrame:
    """Models strictly better than ``gate`` on both RMSE and WMAE (the gate itself excluded)."""
    g = metrics.where(F.col(name_col) == gate)
    rmse_g, wmae_g = g.select("rmse").scalar(), g.select("wmae").scalar()
    return metrics.where((F.col(name_col) != gate) & (F.col("rmse") < rmse_g) & (F.col("wmae") < wmae_g))


def ensemble_members(metrics: DataFrame, gate: str, name_col: str = "model") -> DataFrame:
    """L12 for L13-L16: the gate-beating models if there are at least two of them, else none."""
    m = gate_members(metrics, gate, name_col)
    return m.where(m.agg(F.count(F.lit(1))).scalar() >= 2)


MAX_MODELS = 10_000   # the member / weight tables hold one row per model


def simple_mean(predictions: DataFrame, members: DataFrame) -> DataFrame:
    """Mean prediction over the member models, on keys every member forecast.
    The member table is broadcast after a size check: a join on the few-valued model name
    must never shuffle predictions by model."""
    m = predictions.join(broadcast_if_small(members.select("model"), MAX_MODELS), "model", "left_semi")
    n = members.agg(F.count(F.lit(1))).scalar()
    return (m.groupBy(*KEYS).agg(F.avg("predicted_sales").alias("predicted_sales"), F.count(F.lit(1)).alias("_k"))
             .where(F.col("_k") == n).drop("_k"))


def inverse_rmse_weights(members: DataFrame) -> DataFrame:
    """L14 weights: 1 / RMSE, normalised to sum to 1."""
    w = members.select("model", (1.0 / F.col("rmse")).alias("_w"))
    return w.select("model", (F.col("_w") / w.agg(F.sum("_w")).scalar()).alias("weight"))


def weighted_mean(predictions: DataFrame, members: DataFrame) -> DataFrame:
    """Sum of weight x prediction, on keys every member forecast."""
    w = broadcast_if_small(inverse_rmse_weights(members), MAX_MODELS)
    n = members.agg(F.count(F.lit(1))).scalar()
    m = predictions.join(w, "model")
    return (m.groupBy(*KEYS).agg(F.sum(F.col("predicted_sales") * F.col("weight")).alias("predicted_sales"),
                                 F.count(F.lit(1)).alias("_k"))
             .where(F.col("_k") == n).drop("_k"))


def both_means(predictions: DataFrame, members: DataFrame) -> DataFrame:
    """L13 and L14 at once, as forecasts of the models ``simple`` and ``weighted``: one pass over the
    predictions, one grouping by key, so both are then scored by one join."""
    w = broadcast_if_small(inverse_rmse_weights(members), MAX_MODELS)
    n = members.agg(F.count(F.lit(1))).scalar()
    p = F.col("predicted_sales")
    m = (predictions.join(w, "model").groupBy(*KEYS)
         .agg(F.avg(p).alias("simple"), F.sum(p * F.col("weight")).alias("weighted"), F.count(F.lit(1)).alias("_k"))
         .where(F.col("_k") == n))
    each = F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).alias("predicted_sales")) for c in ("simple", "weighted")])
    return m.select(*KEYS, F.explode(each).alias("_e")).select("_e.model", *KEYS, "_e.predicted_sales")


def choose_ensemble(simple_metrics: DataFrame, weighted_metrics: DataFrame) -> DataFrame:
    """L15: 'weighted' only when its RMSE is strictly lower."""
    s = simple_metrics.select("rmse").scalar()
    w = weighted_metrics.select("rmse").scalar()
    return simple_metrics.select(F.when(w < s, F.lit("weighted")).otherwise(F.lit("simple")).alias("ensemble_method"),
                                 F.least(w, s).alias("rmse"))


def select_best(metrics: DataFrame, gate: str, name_col: str = "model") -> DataFrame:
    """Among models beating ``gate`` on RMSE and WMAE, the lowest RMSE; if none, the lowest RMSE
    of all models.  The gate is a yardstick, never a candidate."""
    valid = gate_members(metrics, gate, name_col)
    best_valid = valid.agg(F.min_by(F.col(name_col), F.struct("rmse", name_col)).alias("_b"))
    best_all = metrics.where(F.col(name_col) != gate).agg(F.min_by(F.col(name_col), F.struct("rmse", name_col)).alias("_b"))
    return best_all.select(F.coalesce(best_valid.select("_b").scalar(), F.col("_b")).alias("best_model"),
                           (best_valid.select("_b").scalar().isNotNull()).alias("beats_gate"))


def top_two(metrics: DataFrame, gate: str, name_col: str = "model") -> DataFrame:
    """The two lowest-RMSE models (name breaks ties), the gate left out."""
    return metrics.where(F.col(name_col) != gate).orderBy("rmse", name_col).limit(2)
