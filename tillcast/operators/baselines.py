"""Rule-based forecasts (I1-I5) as joins and windows instead of per-series loops.

Plan shape, whatever the number of series:

* ``series_summary``: one window (latest rows first) and one group-by on
  (store_id, dept_id), sharing one exchange: last non-null value, last value,
  row count, series mean, mean of the last N rows.
* ``seasonal_matches``: train rows joined to the distinct forecast
  (ISO week, year) pairs on week with ``year < forecast year`` (C7); each row
  meets at most one pair per forecast year, and the K most recent per group
  are taken with a window whose group is bounded by the number of years.
  The same aggregation yields the first row of the year before (C6), so the
  grid needs a single join.  ``first_in_week`` is that lookup on its own.
* the forecast grid is series x forecast dates (C5): the dates are the
  validation calendar (one array from a scalar subquery) and are
  expanded in place with ``explode``, so no join is needed for the grid.

Money stays an exact decimal until the final prediction column, which is double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import DEFAULT, Params
from tillcast.functions.stats import exact_mean
from tillcast.schemas import SERIES
from tillcast.session import broadcast_if_small

# Names of the five baselines
NAIVE = "Naive"
SEASONAL_NAIVE = "Seasonal Naive"
MOVING_AVERAGE = "Moving Average (4 weeks)"
SEASONAL_AVERAGE = "Seasonal Average (k=3)"
HYBRID = "Hybrid Fallback"
BASELINE_NAMES = [NAIVE, SEASONAL_NAIVE, MOVING_AVERAGE, SEASONAL_AVERAGE, HYBRID]


def forecast_dates(actual: DataFrame) -> Column:
    """The sorted distinct dates to forecast, one array: a calendar, found by a scalar
    subquery, so neither the driver nor the plan's size depends on its length."""
    return actual.agg(F.array_sort(F.collect_set("week_date"))).scalar()


def expand_dates(df: DataFrame, dates: Column) -> DataFrame:
    """Every row once per forecast date, with the date's calendar year and ISO week."""
    return (df.withColumn("_dates", dates).withColumn("week_date", F.explode("_dates")).drop("_dates")
              .withColumn("_fyear", F.year("week_date"))
              .withColumn("_fweek", F.weekofyear("week_date")))


def series_summary(train: DataFrame, ma_windows=(4,)) -> DataFrame:
    latest = Window.partitionBy(*SERIES).orderBy(F.desc("week_date"))
    s = F.col("weekly_sales")
    t = train.withColumn("_rn", F.row_number().over(latest))
    aggs = [
        F.max_by(s, F.when(s.isNotNull(), F.col("week_date"))).alias("last_nonnull"),
        F.max_by(s, F.col("week_date")).alias("last_any"),
        F.count(F.lit(1)).alias("n_rows"),
        exact_mean(s).alias("series_mean"),
    ]
    aggs += [exact_mean(F.when(F.col("_rn") <= n, s)).alias(f"mean_last_{n}") for n in sorted(set(ma_windows))]
    return t.groupBy(*SERIES).agg(*aggs)


def first_in_week(train: DataFrame) -> DataFrame:
    """C6 lookup: value of the first row (by date) per (series, calendar year, ISO week)."""
    return (train.groupBy(*SERIES, F.year("week_date").alias("_ly"), F.weekofyear("week_date").alias("_lw"))
                 .agg(F.min_by("weekly_sales", "week_date").alias("sn_value"),
                      F.count(F.lit(1)).alias("sn_rows")))


def seasonal_matches(train: DataFrame, actual: DataFrame, k: int, params: Params = DEFAULT) -> DataFrame:
    """C7 + E13: per (series, forecast week, forecast year): number and mean of all
    same-week rows of earlier years, and mean of the K most recent of them.
    The (week, year) pairs are at most the forecast calendar: broadcast after a size check,
    so the join never shuffles the train rows on a 53-valued week key."""
    pairs = broadcast_if_small(
        actual.select(F.weekofyear("week_date").alias("_fweek"), F.year("week_date").alias("_fyear")).distinct(),
        params.max_forecast_dates)
    rows = train.select(*SERIES, "week_date", "weekly_sales",
                        F.weekofyear("week_date").alias("_w"), F.year("week_date").alias("_y"))
    m = rows.join(pairs, (F.col("_w") == F.col("_fweek")) & (F.col("_y") < F.col("_fyear")))
    recent = Window.partitionBy(*SERIES, "_fweek", "_fyear").orderBy(F.desc("week_date"))
    m = m.withColumn("_rn", F.row_number().over(recent))
    s = F.col("weekly_sales")
    last_year = F.col("_y") == F.col("_fyear") - 1
    return m.groupBy(*SERIES, "_fweek", "_fyear").agg(
        F.count(F.lit(1)).alias("n_match"),
        exact_mean(s).alias("mean_match_all"),
        exact_mean(F.when(F.col("_rn") <= k, s)).alias("mean_match_k"),
        # C6 in the same pass: first row (by date) of the year before, same ISO week
        F.min_by(s, F.when(last_year, F.col("week_date"))).alias("sn_value"),
        F.count_if(last_year).alias("sn_rows"))


def forecast_grid(train: DataFrame, actual: DataFrame, params: Params = DEFAULT,
                  dates: list | None = None) -> DataFrame:
    """Series x dates with every lookup the five rules need (one wide frame)."""
    dates = dates if dates is not None else forecast_dates(actual)
    summ = series_summary(train, (params.moving_average_window, 4))
    grid = expand_dates(summ, dates)
    sm = seasonal_matches(train, actual, params.seasonal_k, params)
    return grid.join(sm, SERIES + ["_fweek", "_fyear"], "left")


def _prediction(grid: DataFrame, name: str, params: Params = DEFAULT) -> F.Column:
    last_any = F.col("last_any")
    if name == NAIVE:
        return F.col("last_nonnull")
    if name == SEASONAL_NAIVE:
        return F.when(F.col("sn_rows") > 0, F.col("sn_value")).otherwise(last_any)
    if name == MOVING_AVERAGE:
        return F.col(f"mean_last_{params.moving_average_window}")
    if name == SEASONAL_AVERAGE:
        return F.when(F.col("n_match").isNotNull(), F.col("mean_match_k")).otherwise(last_any)
    if name == HYBRID:
        n = F.col("n_rows")
        return F.coalesce(
            F.when((n >= 52) & (F.col("sn_rows") > 0), F.col("sn_value").cast("double")),
            F.when(F.col("n_match") >= 2, F.col("mean_match_all")),
            F.when(n >= 4, F.col("mean_last_4")),
            F.col("series_mean"))
    raise KeyError(name)


def predictions(grid: DataFrame, name: str, params: Params = DEFAULT) -> DataFrame:
    """(store_id, dept_id, week_date, predicted_sales); rows with no value are dropped."""
    p = _prediction(grid, name, params).cast("double")
    return (grid.select(*SERIES, "week_date", p.alias("predicted_sales"))
                .where(F.col("predicted_sales").isNotNull()))


def all_predictions(grid: DataFrame, params: Params = DEFAULT, names=BASELINE_NAMES) -> DataFrame:
    """Long frame (model, keys, predicted_sales) for all baselines from one grid pass."""
    cols = [F.struct(F.lit(n).alias("model"), _prediction(grid, n, params).cast("double").alias("p"))
            for n in names]
    return (grid.select(*SERIES, "week_date", F.explode(F.array(*cols)).alias("_m"))
                .select(F.col("_m.model").alias("model"), *SERIES, "week_date",
                        F.col("_m.p").alias("predicted_sales"))
                .where(F.col("predicted_sales").isNotNull()))


def naive_forecast(train, actual, params=DEFAULT):
    """I1"""
    return predictions(forecast_grid(train, actual, params), NAIVE, params)


def seasonal_naive_forecast(train, actual, params=DEFAULT):
    """I2"""
    return predictions(forecast_grid(train, actual, params), SEASONAL_NAIVE, params)


def moving_average_forecast(train, actual, params=DEFAULT):
    """I3"""
    return predictions(forecast_grid(train, actual, params), MOVING_AVERAGE, params)


def seasonal_average_forecast(train, actual, params=DEFAULT):
    """I4"""
    return predictions(forecast_grid(train, actual, params), SEASONAL_AVERAGE, params)


def hybrid_fallback_forecast(train, actual, params=DEFAULT):
    """Seasonal naive if >= 52 rows; else mean of all >= 2 same-week earlier-year rows;
    else mean of the last 4 rows if >= 4 rows; else the series mean.  Null moves on."""
    return predictions(forecast_grid(train, actual, params), HYBRID, params)
