"""Registered queries: star view, split, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.config import DEFAULT
from tillcast.functions.scalars import handle_negative_sales
from tillcast.operators.features import add_holiday_window_features, build_features, null_counts
from tillcast.operators.split import split_counts, take_split, union_splits, with_split
from tillcast.plans.registry import register, with_base
from tillcast.schemas import KEYS, MARKDOWNS, VIEW_COLUMNS, feature_columns
from tillcast.session import durable
from tillcast.sources.fixtures import analytics_view

P = DEFAULT


def view(spark, sf):
    return analytics_view(spark, sf)


def shared_view(spark, sf):
    """The view materialised once (reliable checkpoint) for queries that read it in several
    branches: one scan of the raw tables instead of one per branch."""
    return durable(view(spark, sf))


def split_view(spark, sf, shared: bool = False):
    return with_split(shared_view(spark, sf) if shared else view(spark, sf), P)


def features(spark, sf):
    return build_features(split_view(spark, sf), P)


def shared_features(spark, sf):
    return durable(features(spark, sf))


# -- DuckDB text of the same plan ------------------------------------------------------

SPLIT_SQL = (f"CASE WHEN week_date <= DATE '{P.train_end}' THEN 'train' "
             f"WHEN week_date <= DATE '{P.val_end}' THEN 'val' ELSE 'test' END")
W = "PARTITION BY store_id, dept_id ORDER BY week_date"
WS = "PARTITION BY split, store_id, dept_id ORDER BY week_date"


def mean_sql(c: str, frame: str = "") -> str:
    """Exact-decimal mean, as tillcast.functions.stats.exact_mean / window_mean."""
    over = f" OVER {frame}" if frame else ""
    return (f"CASE WHEN COUNT({c}){over} > 0 THEN "
            f"CAST(SUM({c}){over} AS DOUBLE) / COUNT({c}){over} END")


def _feature_ctes() -> str:
    md_fill = ", ".join(f"COALESCE({m}, 0) AS {m}" for m in MARKDOWNS)
    cols = []
    for k in P.lags:
        cols.append(f"LAG(weekly_sales, {k}) OVER ({W}) AS lag_{k}")
    for n in P.rolling_windows:
        fr = f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        cols.append(f"{mean_sql('weekly_sales', fr)} AS rolling_mean_{n}")
        cols.append(f"STDDEV_SAMP(weekly_sales) OVER {fr} AS rolling_std_{n}")
    cols.append(f"COALESCE(CAST(LAG(isholiday, 1) OVER ({WS}) AS INTEGER), 0) AS is_holiday_prev1")
    cols.append(f"COALESCE(CAST(LEAD(isholiday, 1) OVER ({WS}) AS INTEGER), 0) AS is_holiday_next1")
    for c in P.exogenous:
        for k in P.lags:
            cols.append(f"LAG({c}, {k}) OVER ({W}) AS {c}_lag_{k}")
    for c in P.exogenous:
        for n in P.rolling_windows:
            fr = f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            cols.append(f"{mean_sql(c, fr)} AS {c}_rolling_mean_{n}")
    return f"""
sv AS (SELECT v.*, {SPLIT_SQL} AS split FROM v),
fb AS (
  SELECT store_id, store_type, store_size, dept_id, week_date,
    CASE WHEN weekly_sales < 0 THEN 0 ELSE weekly_sales END AS weekly_sales,
    isholiday, temperature, fuel_price, {md_fill}, cpi, unemployment, split,
    CAST(weekofyear(week_date) AS INTEGER) AS week_of_year, CAST(month(week_date) AS INTEGER) AS month,
    CAST(year(week_date) AS INTEGER) AS year, CAST(dayofyear(week_date) AS INTEGER) AS day_of_year
  FROM sv
),
fm AS (SELECT *, {' + '.join(MARKDOWNS)} AS markdown_total FROM fb),
fw AS (SELECT *, CAST(markdown_total > 0 AS INTEGER) AS has_markdown, {', '.join(cols)} FROM fm),
features AS (
  SELECT *, CAST(is_holiday_prev1 = 1 AS INTEGER) AS within_7days_after_holiday,
         CAST(is_holiday_next1 = 1 AS INTEGER) AS within_7days_before_holiday
  FROM fw
)"""


FEATURE_CTES = _feature_ctes()
FEATURE_COLS = feature_columns(P.lags, P.rolling_windows, P.exogenous)
_DECIMAL_FEATURES = {c for c in FEATURE_COLS if c.startswith("lag_") or "_lag_" in c
                     or c in ("weekly_sales", "markdown_total", "temperature", "fuel_price", "cpi",
                              "unemployment", *MARKDOWNS)}
# sample std is the only feature whose last bits depend on the engine's summation order
_NOISY = {c for c in FEATURE_COLS if "rolling_std" in c}


def _select_rounded(cols) -> str:
    def one(c):
        if c in _NOISY:
            return f"ROUND({c}, 4) AS {c}"
        if c in _DECIMAL_FEATURES:
            return f"CAST({c} AS DOUBLE) AS {c}"
        return c
    return ", ".join(one(c) for c in cols)


def feature_sql(cols, where: str = "") -> str:
    return with_base(FEATURE_CTES, f"SELECT {_select_rounded(cols)} FROM features {where}")


def _pick(cols):
    def q(spark, sf):
        df = features(spark, sf).select(*cols)
        return df.withColumns({c: F.round(c, 4) for c in cols if c in _NOISY})
    return q


# -- queries ------------------------------------------------------------------------------

@register("a11_analytics_view", with_base("", "SELECT * FROM v"))
def q_view(spark, sf):
    """Star join, 16 columns."""
    return view(spark, sf)


@register("b9_split", with_base("", f"SELECT store_id, dept_id, week_date, {SPLIT_SQL} AS split FROM v"))
def q_split(spark, sf):
    return split_view(spark, sf).select(*KEYS, "split")


@register("d33_split_counts", with_base("", f"SELECT {SPLIT_SQL} AS split, COUNT(*) AS n_rows FROM v GROUP BY 1"))
def q_split_counts(spark, sf):
    return split_counts(split_view(spark, sf))


@register("g1_g2_union_and_split", with_base(
    f"sv AS (SELECT v.*, {SPLIT_SQL} AS split FROM v)",
    "SELECT split, COUNT(*) AS n_rows, CAST(SUM(weekly_sales) AS DOUBLE) AS total_sales "
    "FROM sv WHERE split IN ('train', 'val', 'test') GROUP BY split"))
def q_union(spark, sf):
    """G1 then G2: split into three frames, union them back with a marker, split counts."""
    s = split_view(spark, sf).drop("split")
    sv = with_split(s, P)
    parts = {n: take_split(sv, n).drop("split") for n in ("train", "val", "test")}
    u = union_splits(**parts)
    return u.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.sum("weekly_sales").cast("double").alias("total_sales"))


@register("b10_b12_negative_sales", with_base("", """
SELECT store_id, dept_id, week_date,
  CAST(CASE WHEN weekly_sales < 0 THEN 0 ELSE weekly_sales END AS DOUBLE) AS clipped_sales,
  COALESCE(CAST(weekly_sales < 0 AS INTEGER), 0) AS is_return,
  CAST(weekly_sales AS DOUBLE) AS kept_sales
FROM v"""))
def q_negative(spark, sf):
    v = view(spark, sf).select(*KEYS, "weekly_sales")
    flagged = handle_negative_sales(v, "flag")
    kept = handle_negative_sales(flagged, "keep")
    clipped = handle_negative_sales(kept.withColumnRenamed("weekly_sales", "kept_sales")
                                    .withColumn("weekly_sales", F.col("kept_sales")), "clip")
    return clipped.select(*KEYS, F.col("weekly_sales").cast("double").alias("clipped_sales"),
                          "is_return", F.col("kept_sales").cast("double").alias("kept_sales"))


@register("b13_b15_markdown_features", feature_sql(KEYS + MARKDOWNS + ["markdown_total", "has_markdown"]))
def q_markdown(spark, sf):
    return _pick(KEYS + MARKDOWNS + ["markdown_total", "has_markdown"])(spark, sf)


@register("h1_h2_time_features", feature_sql(KEYS + ["week_of_year", "month", "year", "day_of_year"]))
def q_time(spark, sf):
    return _pick(KEYS + ["week_of_year", "month", "year", "day_of_year"])(spark, sf)


LAG_COLS = KEYS + ["weekly_sales"] + [f"lag_{k}" for k in P.lags]
ROLL_MEAN = KEYS + [f"rolling_mean_{n}" for n in P.rolling_windows]
ROLL_STD = KEYS + [f"rolling_std_{n}" for n in P.rolling_windows]
HOL = KEYS + ["split", "isholiday", "is_holiday_prev1", "is_holiday_next1",
              "within_7days_after_holiday", "within_7days_before_holiday"]
EXO_LAG = KEYS + [f"{c}_lag_{k}" for c in P.exogenous for k in P.lags]
EXO_ROLL = KEYS + [f"{c}_rolling_mean_{n}" for c in P.exogenous for n in P.rolling_windows]

register("e1_lag", feature_sql(LAG_COLS))(_pick(LAG_COLS))
register("e2_rolling_mean", feature_sql(ROLL_MEAN))(_pick(ROLL_MEAN))
register("e3_rolling_std", feature_sql(ROLL_STD))(_pick(ROLL_STD))
register("e4_e6_holiday_windows", feature_sql(HOL))(_pick(HOL))
register("e8_exogenous_lags", feature_sql(EXO_LAG))(_pick(EXO_LAG))
register("e9_exogenous_rolling", feature_sql(EXO_ROLL))(_pick(EXO_ROLL))
register("l1_build_features", feature_sql(FEATURE_COLS + ["split"]))(_pick(FEATURE_COLS + ["split"]))


@register("e7_global_holiday_flags", with_base("""
wk AS (SELECT week_date, SUM(weekly_sales) AS total_sales, BOOL_OR(isholiday) AS isholiday FROM v GROUP BY week_date)""",
"""SELECT week_date, CAST(total_sales AS DOUBLE) AS total_sales, isholiday,
  COALESCE(CAST(LAG(isholiday, 1) OVER (ORDER BY week_date) AS INTEGER), 0) AS is_holiday_prev1,
  COALESCE(CAST(LEAD(isholiday, 1) OVER (ORDER BY week_date) AS INTEGER), 0) AS is_holiday_next1,
  CAST(COALESCE(CAST(LAG(isholiday, 1) OVER (ORDER BY week_date) AS INTEGER), 0) = 1 AS INTEGER) AS within_7days_after_holiday,
  CAST(COALESCE(CAST(LEAD(isholiday, 1) OVER (ORDER BY week_date) AS INTEGER), 0) = 1 AS INTEGER) AS within_7days_before_holiday
FROM wk"""))
def q_global_holiday(spark, sf):
    """E7 on a frame without series keys: one row per week (calendar-bounded), so the
    single ordered window partition holds a few hundred rows whatever the data size."""
    wk = (view(spark, sf).groupBy("week_date")
          .agg(F.sum("weekly_sales").alias("total_sales"), F.bool_or("isholiday").alias("isholiday")))
    out = add_holiday_window_features(wk, None)
    return out.select("week_date", F.col("total_sales").cast("double").alias("total_sales"), "isholiday",
                      "is_holiday_prev1", "is_holiday_next1",
                      "within_7days_after_holiday", "within_7days_before_holiday")


_NULL_COLS = [c for c in FEATURE_COLS]


@register("d31_feature_null_counts", with_base(FEATURE_CTES, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM features"
    for c in _NULL_COLS) + ") WHERE null_count > 0"))
def q_feature_nulls(spark, sf):
    return null_counts(features(spark, sf), _NULL_COLS).where(F.col("null_count") > 0)


@register("a10_fact_table", with_base("", "SELECT * FROM fact"))
def q_fact(spark, sf):
    """A10: the fact table with its stored decimal types."""
    from tillcast.sources.fixtures import fact_sales
    return fact_sales(spark, sf)


__all__ = ["view", "split_view", "features", "FEATURE_CTES", "SPLIT_SQL", "VIEW_COLUMNS"]
