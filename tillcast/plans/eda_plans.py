"""Registered queries: data-quality summaries and exploratory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import eda
from tillcast.plans.feature_plans import shared_view, view
from tillcast.plans.registry import register, with_base
from tillcast.schemas import MARKDOWNS, VIEW_COLUMNS
from tillcast.session import durable
from tillcast.sources.fixtures import DEFECT_CTES, defective, fact_sales

N_TOP_STORES = 10   # the stand-in data has 5
N_TOP_DEPTS = 15

ANY_MD = "COALESCE(" + ", ".join(MARKDOWNS) + ") IS NOT NULL"


def _mean(c):
    return f"CASE WHEN COUNT({c}) > 0 THEN CAST(SUM({c}) AS DOUBLE) / COUNT({c}) END"


@register("d3_missing_values", with_base("", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"ROUND(COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) * 100, 2) AS missing_pct FROM v"
    for c in VIEW_COLUMNS) + ") WHERE missing_count > 0"))
def q_missing(spark, sf):
    return eda.missing_values(view(spark, sf))


@register("d4_duplicate_key_groups", with_base(DEFECT_CTES, """
SELECT store_id, dept_id, week_date, COUNT(*) AS n_rows FROM bad
GROUP BY store_id, dept_id, week_date HAVING COUNT(*) > 1"""))
def q_dup_groups(spark, sf):
    return eda.duplicate_groups(defective(fact_sales(spark, sf)))


@register("d5_surplus_duplicates", with_base(DEFECT_CTES, """
SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT COUNT(*) AS c FROM bad GROUP BY store_id, dept_id, week_date)"""))
def q_surplus(spark, sf):
    return eda.surplus_duplicates(defective(fact_sales(spark, sf)))


@register("d6_date_range", with_base("", "SELECT MIN(week_date) AS min_date, MAX(week_date) AS max_date, COUNT(*) AS n_rows FROM v"))
def q_dates(spark, sf):
    return view(spark, sf).agg(F.min("week_date").alias("min_date"), F.max("week_date").alias("max_date"),
                               F.count(F.lit(1)).alias("n_rows"))


NEG_SQL = """COUNT(*) FILTER (WHERE weekly_sales < 0) AS negative_sales_count,
  COUNT(*) FILTER (WHERE weekly_sales < 0) / COUNT(*) * 100 AS negative_sales_pct,
  CAST(MIN(CASE WHEN weekly_sales < 0 THEN weekly_sales END) AS DOUBLE) AS negative_sales_min"""


@register("d7_negative_sales", with_base("", f"SELECT {NEG_SQL} FROM v"))
def q_negative(spark, sf):
    return eda.negative_summary(view(spark, sf))


IQR_CTES = """
qs AS (SELECT quantile_cont(CAST(weekly_sales AS DOUBLE), 0.25) AS q1,
              quantile_cont(CAST(weekly_sales AS DOUBLE), 0.75) AS q3 FROM v),
b AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM qs),
o AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE CAST(weekly_sales AS DOUBLE) < b.lower_bound
                                          OR CAST(weekly_sales AS DOUBLE) > b.upper_bound) AS outliers_count
      FROM v, b)"""


@register("d8_iqr_outliers", with_base(IQR_CTES, """
SELECT q1, q3, iqr, lower_bound, upper_bound, outliers_count, outliers_count / n * 100 AS outliers_pct FROM b, o"""))
def q_iqr(spark, sf):
    return eda.iqr_outliers(shared_view(spark, sf), materialized=True)


@register("d29_sanity_summary", with_base(IQR_CTES + """,
miss AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM v" for c in VIEW_COLUMNS) + """) WHERE missing_count > 0),
dup AS (SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS duplicates
        FROM (SELECT COUNT(*) AS c FROM v GROUP BY store_id, dept_id, week_date)),
neg AS (SELECT """ + NEG_SQL + """ FROM v)""", """
SELECT (SELECT COUNT(*) FROM miss) AS columns_with_missing,
  (SELECT CAST(COALESCE(SUM(missing_count), 0) AS BIGINT) FROM miss) AS missing_total,
  dup.duplicates, neg.negative_sales_count, neg.negative_sales_pct, neg.negative_sales_min,
  o.outliers_count, o.outliers_count / o.n * 100 AS outliers_pct
FROM dup, neg, o"""))
def q_sanity(spark, sf):
    return eda.sanity_summary(view(spark, sf))


@register("d9_weekly_total_sales", with_base("", "SELECT week_date, CAST(SUM(weekly_sales) AS DOUBLE) AS total_sales FROM v GROUP BY week_date"))
def q_weekly(spark, sf):
    return eda.weekly_totals(view(spark, sf))


@register("d10_sales_by_store_type", with_base("", """
SELECT week_date,
  CAST(SUM(CASE WHEN store_type = 'A' THEN weekly_sales END) AS DOUBLE) AS type_A,
  CAST(SUM(CASE WHEN store_type = 'B' THEN weekly_sales END) AS DOUBLE) AS type_B,
  CAST(SUM(CASE WHEN store_type = 'C' THEN weekly_sales END) AS DOUBLE) AS type_C
FROM v GROUP BY week_date"""))
def q_by_type(spark, sf):
    return eda.sales_by_store_type(view(spark, sf))


@register("f2_top_stores", with_base("", f"""
SELECT store_id, CAST(SUM(weekly_sales) AS DOUBLE) AS total_sales FROM v GROUP BY store_id
ORDER BY SUM(weekly_sales) DESC, store_id LIMIT {N_TOP_STORES}"""))
def q_top_stores(spark, sf):
    return eda.top_by_sales(view(spark, sf), "store_id", N_TOP_STORES)


@register("f3_top_depts", with_base("", f"""
SELECT dept_id, CAST(SUM(weekly_sales) AS DOUBLE) AS total_sales FROM v GROUP BY dept_id
ORDER BY SUM(weekly_sales) DESC, dept_id LIMIT {N_TOP_DEPTS}"""))
def q_top_depts(spark, sf):
    return eda.top_by_sales(view(spark, sf), "dept_id", N_TOP_DEPTS)


def _summary_sql(label_expr, with_std, where=""):
    std = ", ROUND(STDDEV_SAMP(weekly_sales), 4) AS std_sales" if with_std else ""
    return with_base(f"t AS (SELECT {label_expr} AS type, weekly_sales FROM v {where})", f"""
SELECT type, COUNT(*) AS count, {_mean('weekly_sales')} AS mean_sales{std},
  quantile_cont(CAST(weekly_sales AS DOUBLE), 0.5) AS median_sales
FROM t GROUP BY type""")


@register("d11_holiday_summary", _summary_sql(
    "CASE WHEN isholiday THEN 'Holiday' ELSE 'Non-Holiday' END", True, "WHERE isholiday IS NOT NULL"))
def q_holiday_summary(spark, sf):
    out = eda.holiday_summary(shared_view(spark, sf), materialized=True)
    return out.withColumn("std_sales", F.round("std_sales", 4))


@register("d12_markdown_comparison", _summary_sql(
    f"CASE WHEN {ANY_MD} THEN 'With Markdown' ELSE 'Without Markdown' END", False))
def q_markdown_cmp(spark, sf):
    return eda.markdown_comparison(shared_view(spark, sf), materialized=True)


@register("d13_markdown_by_month", with_base("", f"""
SELECT strftime(week_date, '%Y-%m') AS year_month,
  COUNT(*) FILTER (WHERE {ANY_MD}) / COUNT(*) * 100 AS pct_with_markdown
FROM v GROUP BY 1"""))
def q_md_month(spark, sf):
    return eda.markdown_by_month(view(spark, sf))


@register("d14_weeks_per_series", with_base("", "SELECT store_id, dept_id, COUNT(*) AS n_weeks FROM v GROUP BY store_id, dept_id"))
def q_weeks(spark, sf):
    return eda.weeks_per_series(view(spark, sf))


@register("d15_cold_start_series", with_base(DEFECT_CTES, """
SELECT store_id, dept_id, COUNT(*) AS n_weeks FROM bad GROUP BY store_id, dept_id HAVING COUNT(*) < 26"""))
def q_cold(spark, sf):
    return eda.cold_start(defective(fact_sales(spark, sf)))


SERIES_STATS_CTE = f"""
ss0 AS (SELECT store_id, dept_id, {_mean('weekly_sales')} AS mean_sales,
          STDDEV_SAMP(weekly_sales) AS std_sales, COUNT(weekly_sales) AS n_weeks
        FROM v GROUP BY store_id, dept_id),
ss1 AS (SELECT *, CASE WHEN mean_sales <> 0 THEN std_sales / mean_sales
                       WHEN std_sales > 0 THEN CAST('inf' AS DOUBLE) END AS cv FROM ss0),
ss AS (SELECT *, CASE WHEN cv IS NULL OR isnan(cv) OR cv <= 0 THEN NULL
                      WHEN cv <= 0.3 THEN '{eda.VOLATILITY_LABELS[0]}'
                      WHEN cv <= 0.6 THEN '{eda.VOLATILITY_LABELS[1]}'
                      WHEN cv <= 1.0 THEN '{eda.VOLATILITY_LABELS[2]}'
                      ELSE '{eda.VOLATILITY_LABELS[3]}' END AS volatility_bucket FROM ss1)"""


@register("d16_d17_series_statistics", with_base(SERIES_STATS_CTE, """
SELECT store_id, dept_id, mean_sales, ROUND(std_sales, 4) AS std_sales, n_weeks, ROUND(cv, 4) AS cv,
  volatility_bucket FROM ss"""))
def q_series_stats(spark, sf):
    s = eda.series_statistics(view(spark, sf))
    return s.withColumns({"std_sales": F.round("std_sales", 4), "cv": F.round("cv", 4)})


@register("d18_volatility_counts", with_base(SERIES_STATS_CTE + ",\nlab AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{lab}')" for i, lab in enumerate(eda.VOLATILITY_LABELS)) + ") t(bucket_order, volatility_bucket))", """
SELECT lab.bucket_order, lab.volatility_bucket, COALESCE(c.n_series, 0) AS n_series
FROM lab LEFT JOIN (SELECT volatility_bucket, COUNT(*) AS n_series FROM ss GROUP BY 1) c
  ON lab.volatility_bucket = c.volatility_bucket"""))
def q_vol_counts(spark, sf):
    return eda.volatility_counts(eda.series_statistics(view(spark, sf)))


def _hist_sql(src: str, bins: int, by: str | None) -> str:
    byc = f"{by}, " if by else ""
    join = f"JOIN bnd USING ({by})" if by else ", bnd"
    grp = f"GROUP BY {by}" if by else ""
    return with_base(f"""
src AS ({src}),
bnd AS (SELECT {byc}MIN(x) AS lo, MAX(x) AS hi, COUNT(*) AS n FROM src {grp}),
j AS (SELECT {byc}x, lo, hi, n,
  CASE WHEN hi = lo THEN 1 ELSE LEAST(CAST(FLOOR((x - lo) * {bins} / (hi - lo)) AS INTEGER) + 1, {bins}) END AS bin
  FROM src {join})""", f"""
SELECT {byc}bin, lo + (bin - 1) * ((hi - lo) / {bins}) AS bin_start, lo + bin * ((hi - lo) / {bins}) AS bin_end,
  COALESCE(c, 0) AS count,
  CASE WHEN hi > lo THEN COALESCE(c, 0) / (n * ((hi - lo) / {bins})) END AS density
FROM bnd CROSS JOIN (SELECT UNNEST(range(1, {bins + 1})) AS bin) e
LEFT JOIN (SELECT {byc}bin, COUNT(*) AS c FROM j GROUP BY {byc}bin) f USING ({byc}bin)""")


@register("d19_holiday_histogram", _hist_sql(
    "SELECT isholiday, CAST(weekly_sales AS DOUBLE) AS x FROM v WHERE weekly_sales IS NOT NULL", 50, "isholiday"))
def q_hist_holiday(spark, sf):
    return eda.histogram(shared_view(spark, sf), "weekly_sales", 50, by=["isholiday"])


@register("d20_series_length_histogram", _hist_sql(
    "SELECT CAST(COUNT(*) AS DOUBLE) AS x FROM v GROUP BY store_id, dept_id", 30, None))
def q_hist_len(spark, sf):
    return eda.histogram(durable(eda.weeks_per_series(view(spark, sf))), "n_weeks", 30)


@register("d21_dashboard_weekly", with_base("", """
SELECT week_date, CAST(SUM(weekly_sales) AS DOUBLE) AS total_sales,
  COUNT(*) FILTER (WHERE isholiday) AS n_holiday_stores FROM v GROUP BY week_date"""))
def q_dash_weekly(spark, sf):
    return eda.dashboard_weekly(view(spark, sf))


@register("d22_dashboard_store_weekly", with_base("", """
SELECT week_date, store_id, CAST(SUM(weekly_sales) AS DOUBLE) AS weekly_sales,
  MIN(store_type) AS store_type, MIN(store_size) AS store_size FROM v GROUP BY week_date, store_id"""))
def q_dash_store(spark, sf):
    return eda.dashboard_store_weekly(view(spark, sf))


@register("d23_dashboard_dept_weekly", with_base("", """
SELECT week_date, dept_id, CAST(SUM(weekly_sales) AS DOUBLE) AS weekly_sales FROM v GROUP BY week_date, dept_id"""))
def q_dash_dept(spark, sf):
    return eda.dashboard_dept_weekly(view(spark, sf))


@register("e10_dept_volume_rank", with_base("", """
SELECT dept_id, CAST(SUM(weekly_sales) AS DOUBLE) AS total_sales,
  ROW_NUMBER() OVER (ORDER BY SUM(weekly_sales) DESC, dept_id) AS rank FROM v GROUP BY dept_id"""))
def q_dept_rank(spark, sf):
    return eda.dept_volume_rank(view(spark, sf))


@register("d24_dept_volatility_rank", with_base(SERIES_STATS_CTE, """
SELECT dept_id, ROUND(AVG(cv), 4) AS avg_cv,
  ROW_NUMBER() OVER (ORDER BY AVG(cv) DESC NULLS LAST, dept_id) AS rank FROM ss GROUP BY dept_id"""))
def q_dept_vol(spark, sf):
    r = eda.dept_volatility_rank(eda.series_statistics(view(spark, sf)))
    return r.withColumn("avg_cv", F.round("avg_cv", 4))


@register("f5_negative_head", with_base("", """
SELECT store_id, dept_id, week_date, CAST(weekly_sales AS DOUBLE) AS weekly_sales FROM v
WHERE weekly_sales < 0 ORDER BY store_id, dept_id, week_date LIMIT 10"""))
def q_neg_head(spark, sf):
    return (eda.negative_head(view(spark, sf), 10)
            .select("store_id", "dept_id", "week_date", F.col("weekly_sales").cast("double")))


# Names that Spark gives to the types of the view's columns
TYPES = {"store_id": "int", "store_type": "string", "store_size": "int", "dept_id": "int", "week_date": "date", "isholiday": "boolean",
         "weekly_sales": "decimal(18,2)", "temperature": "decimal(6,2)", "fuel_price": "decimal(6,3)", **dict.fromkeys(MARKDOWNS, "decimal(18,4)"),
         "cpi": "decimal(10,7)", "unemployment": "decimal(6,3)"}


@register("d28_dtypes", with_base("", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{TYPES[c]}' AS data_type, COUNT({c}) AS non_null FROM v" for c in VIEW_COLUMNS)))
def q_dtypes(spark, sf):
    """Schema listing of the analytics view, with the non-null values of each column."""
    return eda.dtypes_frame(view(spark, sf))


@register("f6_duplicate_groups_head", with_base(DEFECT_CTES, """
SELECT store_id, dept_id, week_date, COUNT(*) AS n_rows FROM bad GROUP BY store_id, dept_id, week_date
HAVING COUNT(*) > 1 ORDER BY store_id NULLS FIRST, dept_id, week_date LIMIT 5"""))
def q_dup_head(spark, sf):
    """the first five duplicate key groups (top-k over the duplicate groups only)."""
    return eda.duplicate_groups(defective(fact_sales(spark, sf))).orderBy("store_id", "dept_id", "week_date").limit(5)


@register("b16_markdown_flags", with_base("", f"""
SELECT {ANY_MD} AS any_markdown,
  (COALESCE(markdown1, 0) + COALESCE(markdown2, 0) + COALESCE(markdown3, 0) + COALESCE(markdown4, 0)
   + COALESCE(markdown5, 0)) > 0 AS positive_total, COUNT(*) AS n_rows
FROM v GROUP BY 1, 2"""))
def q_md_flags(spark, sf):
    """B16 against B15: the EDA flag (any markdown present) beside the feature flag (total > 0)."""
    from tillcast.functions.scalars import add_markdown_features, any_markdown
    v = view(spark, sf).withColumn("any_markdown", any_markdown())
    f = add_markdown_features(v)
    return (f.groupBy("any_markdown", (F.col("markdown_total") > 0).alias("positive_total"))
             .agg(F.count(F.lit(1)).alias("n_rows")))
