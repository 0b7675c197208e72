"""Forecast error metrics (I6-I10) as aggregate expressions: one pass, any grouping.

Pairs with a null actual or prediction are skipped (the reference's numpy mean
would turn the whole metric into NaN).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast.functions.scalars import holiday_weight


def _pair(actual: str, predicted: str):
    a = F.col(actual).cast("double")
    p = F.col(predicted).cast("double")
    ok = a.isNotNull() & p.isNotNull()
    return a, p, ok


def rmse(actual="weekly_sales", predicted="predicted_sales") -> Column:
    """sqrt(mean(e^2))."""
    a, p, ok = _pair(actual, predicted)
    return F.sqrt(F.avg(F.when(ok, (a - p) * (a - p))))


def mae(actual="weekly_sales", predicted="predicted_sales") -> Column:
    """mean(|e|)."""
    a, p, ok = _pair(actual, predicted)
    return F.avg(F.when(ok, F.abs(a - p)))


def mape(actual="weekly_sales", predicted="predicted_sales", threshold: float = 1.0) -> Column:
    """I8: mean(|e / a|) * 100 over actual >= threshold; null when no such row."""
    a, p, ok = _pair(actual, predicted)
    return F.avg(F.when(ok & (a >= threshold), F.abs((a - p) / a) * 100))


def r_squared(actual="weekly_sales", predicted="predicted_sales") -> Column:
    """1 - SS_res / SS_tot; null when the actuals have no spread."""
    a, p, ok = _pair(actual, predicted)
    aa = F.when(ok, a)
    ss_tot = F.var_pop(aa) * F.count(aa)
    return F.when(ss_tot > 0, 1 - F.sum(F.when(ok, (a - p) * (a - p))) / ss_tot)


def wmae(actual="weekly_sales", predicted="predicted_sales", flag="isholiday", weight: float = 5.0) -> Column:
    """sum(w |e|) / sum(w), w = weight on holiday rows, else 1."""
    a, p, ok = _pair(actual, predicted)
    w = holiday_weight(flag, weight)
    return F.sum(F.when(ok, w * F.abs(a - p))) / F.sum(F.when(ok, w))


def metric_columns(with_wmae: bool = True, holiday_weight_value: float = 5.0,
                   threshold: float = 1.0, actual="weekly_sales", predicted="predicted_sales") -> list[Column]:
    cols = [rmse(actual, predicted).alias("rmse"), mae(actual, predicted).alias("mae")]
    if with_wmae:
        cols.append(wmae(actual, predicted, weight=holiday_weight_value).alias("wmae"))
    ok = _pair(actual, predicted)[2]
    cols += [mape(actual, predicted, threshold).alias("mape"),
             r_squared(actual, predicted).alias("r_squared"),
             F.count_if(ok).alias("n_samples")]
    return cols


METRIC_ROUNDING = {"rmse": 4, "mae": 4, "wmae": 4, "mape": 4, "r_squared": 6}


def rounded(df, extra: dict | None = None):
    """Round metric columns (B22); r squared keeps 6 places."""
    spec = dict(METRIC_ROUNDING)
    spec.update(extra or {})
    return df.withColumns({c: F.round(c, k) for c, k in spec.items() if c in df.columns})
