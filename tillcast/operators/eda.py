"""Exploratory tables.

Every table is one or two aggregations over the analytics view.  Global
orderings (ranks, top-k) only run on aggregates whose size is bounded by a
dimension (stores, departments, weeks, volatility buckets), never on the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import DEFAULT, Params
from tillcast.functions.quantiles import percentile_columns
from tillcast.functions.scalars import any_markdown, month_label
from tillcast.functions.stats import exact_mean, mean_of
from tillcast.schemas import KEYS, SERIES
from tillcast.session import broadcast_if_small, durable

# Volatility buckets (right-closed bins 0, .3, .6, 1, inf) and their labels
VOLATILITY_LABELS = ["Low (CV<0.3)", "Medium (0.3≤CV<0.6)", "High (0.6≤CV<1.0)", "Very High (CV≥1.0)"]
VOLATILITY_EDGES = [0.0, 0.3, 0.6, 1.0]


def missing_values(df: DataFrame) -> DataFrame:
    """D3: (column_name, missing_count, missing_pct) for columns with any null."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.selectExpr("_n", f"stack({len(cols)}, {pairs}) AS (column_name, missing_count)")
    return (long.where(F.col("missing_count") > 0)
                .select("column_name", "missing_count",
                        F.round(F.col("missing_count") / F.col("_n") * 100, 2).alias("missing_pct")))


def duplicate_groups(df: DataFrame, keys=KEYS) -> DataFrame:
    """Key groups holding more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def surplus_duplicates(df: DataFrame, keys=KEYS) -> DataFrame:
    """Rows beyond the first of each key (pandas duplicated().sum())."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
              .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates")))


def negative_summary(df: DataFrame, col: str = "weekly_sales") -> DataFrame:
    """Count, percent and minimum of negative values."""
    c = F.col(col)
    return df.agg(F.count_if(c < 0).alias("negative_sales_count"),
                  (F.count_if(c < 0) / F.count(F.lit(1)) * 100).alias("negative_sales_pct"),
                  F.min(F.when(c < 0, c)).cast("double").alias("negative_sales_min"))


def iqr_outliers(df: DataFrame, col: str = "weekly_sales", materialized: bool = False) -> DataFrame:
    """Exact quartiles, 1.5 IQR bounds, outlier count and percent (one extra pass)."""
    q = percentile_columns(df, col, {"q1": 0.25, "q3": 0.75}, materialized=materialized)
    iqr = F.col("q3") - F.col("q1")
    b = q.select(F.struct(F.col("q1"), F.col("q3"), iqr.alias("iqr"),
                          (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
                          (F.col("q3") + 1.5 * iqr).alias("upper_bound")).alias("b"))
    bounds = b.select("b").scalar()   # one row, one subquery (reused wherever referenced)
    x = F.col(col).cast("double")
    cnt = df.agg(F.count(F.lit(1)).alias("_n"),
                 F.count_if((x < bounds["lower_bound"]) | (x > bounds["upper_bound"])).alias("outliers_count"),
                 bounds.alias("_b"))
    return cnt.select(*[F.col("_b")[c].alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
                      "outliers_count", (F.col("outliers_count") / F.col("_n") * 100).alias("outliers_pct"))


def sanity_summary(df: DataFrame) -> DataFrame:
    """One row of the checks above.  The view is materialised once (it feeds four
    aggregations); single-pass counts share one aggregate, the rest are one-row subqueries."""
    x = durable(df)
    cols = x.columns
    c = F.col("weekly_sales")
    base = x.agg(F.count(F.lit(1)).alias("_n"),
                 F.array(*[F.count_if(F.col(k).isNull()) for k in cols]).alias("_miss"),
                 F.count_if(c < 0).alias("negative_sales_count"),
                 F.min(F.when(c < 0, c)).cast("double").alias("negative_sales_min"))
    dup = surplus_duplicates(x).select(F.struct("duplicates").alias("d")).select("d").scalar()
    out = (iqr_outliers(x, materialized=True).select(F.struct("outliers_count", "outliers_pct").alias("o"))
           .select("o").scalar())
    missing = F.filter(F.col("_miss"), lambda m: m > 0)
    return base.select(
        F.size(missing).cast("long").alias("columns_with_missing"),
        F.aggregate(missing, F.lit(0).cast("long"), lambda a, m: a + m).alias("missing_total"),
        dup["duplicates"].alias("duplicates"),
        "negative_sales_count",
        (F.col("negative_sales_count") / F.col("_n") * 100).alias("negative_sales_pct"),
        "negative_sales_min",
        out["outliers_count"].alias("outliers_count"), out["outliers_pct"].alias("outliers_pct"))


def weekly_totals(df: DataFrame) -> DataFrame:
    """D9"""
    return df.groupBy("week_date").agg(F.sum("weekly_sales").cast("double").alias("total_sales"))


MAX_STORE_TYPES = 1_000


def sales_by_store_type(df: DataFrame, types=None) -> DataFrame:
    """One column per store type found in the data (few: a report column each; beyond
    MAX_STORE_TYPES it raises rather than drop one)."""
    if types is None:
        found = df.select("store_type").where("store_type is not null").distinct().limit(MAX_STORE_TYPES + 1).collect()
        if len(found) > MAX_STORE_TYPES:
            raise ValueError("too many store types for one column each")
        types = sorted(r[0] for r in found)
    p = df.groupBy("week_date").pivot("store_type", list(types)).agg(F.sum("weekly_sales"))
    return p.select("week_date", *[F.col(t).cast("double").alias(f"type_{t}") for t in types])


def top_by_sales(df: DataFrame, key: str, n: int) -> DataFrame:
    """Top n keys by total sales, key as tie-break (aggregate is dimension-sized)."""
    return (df.groupBy(key).agg(F.sum("weekly_sales").alias("total_sales"))
              .orderBy(F.desc("total_sales"), F.asc(key)).limit(n)
              .select(key, F.col("total_sales").cast("double").alias("total_sales")))


def group_summary(df: DataFrame, flag: F.Column, labels: tuple[str, str], with_std: bool,
                  materialized: bool = False) -> DataFrame:
    """Count, mean, exact median (and sample std) for flag true / false."""
    t = df.select(F.when(flag, labels[0]).otherwise(labels[1]).alias("type"),
                  F.col("weekly_sales"))
    aggs = [F.count(F.lit(1)).alias("count"), exact_mean(F.col("weekly_sales")).alias("mean_sales")]
    if with_std:
        aggs.append(F.stddev_samp("weekly_sales").alias("std_sales"))
    base = t.groupBy("type").agg(*aggs)
    med = percentile_columns(t, "weekly_sales", {"median_sales": 0.5}, by=["type"], materialized=materialized)
    return base.join(med, "type", "left")


def holiday_summary(df: DataFrame, materialized: bool = False) -> DataFrame:
    """Rows with isholiday true against false (null is neither)."""
    h = df.where(F.col("isholiday").isNotNull())
    return group_summary(h, F.col("isholiday"), ("Holiday", "Non-Holiday"), True, materialized)


def markdown_comparison(df: DataFrame, materialized: bool = False) -> DataFrame:
    """D12 (B16 flag: any markdown present)."""
    return group_summary(df, any_markdown(), ("With Markdown", "Without Markdown"), False, materialized)


def markdown_by_month(df: DataFrame) -> DataFrame:
    """Percent of rows with any markdown, per yyyy-MM."""
    return (df.groupBy(month_label("week_date").alias("year_month"))
              .agg((F.count_if(any_markdown()) / F.count(F.lit(1)) * 100).alias("pct_with_markdown")))


def weeks_per_series(df: DataFrame) -> DataFrame:
    """Rows per series (size(), nulls counted)."""
    return df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_weeks"))


def cold_start(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Series shorter than the threshold."""
    return weeks_per_series(df).where(F.col("n_weeks") < params.cold_start_weeks)


def series_statistics(df: DataFrame) -> DataFrame:
    """Mean, sample std, non-null count, cv and volatility bucket per series.
    cv is null at mean 0 with std 0 or null; mean 0 with std > 0 is +inf (top bucket)."""
    s = df.groupBy(*SERIES).agg(mean_of(df, "weekly_sales").alias("mean_sales"),
                                F.stddev_samp("weekly_sales").alias("std_sales"),
                                F.count("weekly_sales").alias("n_weeks"))
    cv = (F.when(F.col("mean_sales") != 0, F.col("std_sales") / F.col("mean_sales"))
           .when(F.col("std_sales") > 0, F.lit(float("inf"))))
    s = s.withColumn("cv", cv)
    return s.withColumn("volatility_bucket", volatility_bucket(F.col("cv")))


def volatility_bucket(cv: F.Column) -> F.Column:
    """Pd.cut right-closed bins; 0 and below, NaN -> null."""
    e = VOLATILITY_EDGES
    return (F.when(cv.isNull() | F.isnan(cv) | (cv <= e[0]), F.lit(None).cast("string"))
             .when(cv <= e[1], VOLATILITY_LABELS[0])
             .when(cv <= e[2], VOLATILITY_LABELS[1])
             .when(cv <= e[3], VOLATILITY_LABELS[2])
             .otherwise(VOLATILITY_LABELS[3]))


def volatility_counts(stats: DataFrame) -> DataFrame:
    """Series per bucket in bucket order, empty buckets kept (label table left join)."""
    spark = stats.sparkSession
    labels = spark.createDataFrame([(i, lab) for i, lab in enumerate(VOLATILITY_LABELS)],
                                   "bucket_order int, volatility_bucket string")
    counts = stats.groupBy("volatility_bucket").agg(F.count(F.lit(1)).alias("n_series"))
    return (labels.join(counts, "volatility_bucket", "left")
                  .select("bucket_order", "volatility_bucket",
                          F.coalesce("n_series", F.lit(0)).alias("n_series")))


def histogram(df: DataFrame, col: str, bins: int, by=()) -> DataFrame:
    """``bins`` equal-width bins over each group's own min and max, last edge closed,
    empty ones with count 0; count and density (count / (n * width)).  Two passes: bounds, counts."""
    by = list(by)
    x = F.col(col).cast("double")
    src = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    bounds = src.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                  F.count(F.lit(1)).alias("_n"))
    if by:
        # one row per group: broadcast after a check, never a shuffle on a few-valued key
        j = src.join(broadcast_if_small(bounds, 100_000), by)
    else:  # one row of bounds: scalar subqueries instead of a join
        j = src.select("_x", bounds.select(F.struct("_lo", "_hi", "_n")).scalar().alias("_b")).select("_x", "_b.*")
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))).cast("int") + 1,
                F.lit(bins)))
    found = j.groupBy(*by, idx.alias("bin")).agg(F.count(F.lit(1)).alias("_c"))
    edges = (bounds.where(F.col("_n") > 0).dropna(subset=by or None)
             .withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins)))))
    same = edges["bin"] == found["bin"]
    for c in by:
        same = same & edges[c].eqNullSafe(found[c])
    g = (edges.join(found, same, "left")
         .select(*[edges[c] for c in by], edges["bin"], "_lo", "_hi", "_n", F.coalesce("_c", F.lit(0)).alias("count")))
    return g.select(*by, "bin",
                    (F.col("_lo") + (F.col("bin") - 1) * width).alias("bin_start"),
                    (F.col("_lo") + F.col("bin") * width).alias("bin_end"),
                    "count",
                    F.when(F.col("_hi") > F.col("_lo"), F.col("count") / (F.col("_n") * width)).alias("density"))


def dashboard_weekly(df: DataFrame) -> DataFrame:
    """Total sales and number of holiday rows per week."""
    return df.groupBy("week_date").agg(F.sum("weekly_sales").cast("double").alias("total_sales"),
                                       F.count_if(F.col("isholiday")).alias("n_holiday_stores"))


def dashboard_store_weekly(df: DataFrame) -> DataFrame:
    """Store attributes are constant per store, so min is a deterministic 'first'."""
    return df.groupBy("week_date", "store_id").agg(
        F.sum("weekly_sales").cast("double").alias("weekly_sales"),
        F.min("store_type").alias("store_type"), F.min("store_size").alias("store_size"))


def dashboard_dept_weekly(df: DataFrame) -> DataFrame:
    """D23"""
    return df.groupBy("week_date", "dept_id").agg(F.sum("weekly_sales").cast("double").alias("weekly_sales"))


def dept_volume_rank(df: DataFrame) -> DataFrame:
    """Departments by total sales, rank 1..n without ties (id breaks ties).
    The window runs over one row per department."""
    t = df.groupBy("dept_id").agg(F.sum("weekly_sales").alias("total_sales"))
    w = Window.orderBy(F.desc("total_sales"), F.asc("dept_id"))
    return t.select("dept_id", F.col("total_sales").cast("double").alias("total_sales"),
                    F.row_number().over(w).alias("rank"))


def dept_volatility_rank(stats: DataFrame) -> DataFrame:
    """Mean cv per department from the series statistics frame, ranked."""
    t = stats.groupBy("dept_id").agg(F.avg("cv").alias("avg_cv"))
    w = Window.orderBy(F.desc_nulls_last("avg_cv"), F.asc("dept_id"))
    return t.select("dept_id", "avg_cv", F.row_number().over(w).alias("rank"))


def negative_head(df: DataFrame, n: int = 10) -> DataFrame:
    """first n negative rows in (store, dept, week) order."""
    return df.where(F.col("weekly_sales") < 0).orderBy(*KEYS).limit(n)


def dtypes_frame(df: DataFrame) -> DataFrame:
    """Column name, type and non-null count per column (one pass; stacked, not collected)."""
    pairs = ", ".join(f"'{c}', '{t}', `{c}`" for c, t in df.dtypes)
    agg = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return agg.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, data_type, non_null)")
