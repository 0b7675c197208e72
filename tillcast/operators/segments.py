"""Evaluation segments on the validation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.quantiles import percentile_columns
from tillcast.functions.stats import mean_of
from tillcast.schemas import SERIES

# Segment labels
QUARTILE_LABELS = ["Q1 (Low)", "Q2 (Medium-Low)", "Q3 (Medium-High)", "Q4 (High)"]
TOP_LABEL, OTHER_LABEL = "Top 10", "Other"


def series_means(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(mean_of(df, "weekly_sales").alias("series_mean"))


def volume_quartiles(df: DataFrame) -> DataFrame:
    """Series mean, then Q1..Q4 by the 25/50/75 % points of the series means
    (edges inclusive; a null mean falls through to Q4 like the reference)."""
    means = series_means(df)
    q = percentile_columns(means, "series_mean", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    m, at = F.col("series_mean"), F.col("_q")
    label = (F.when(m <= at["p25"], QUARTILE_LABELS[0])
              .when(m <= at["p50"], QUARTILE_LABELS[1])
              .when(m <= at["p75"], QUARTILE_LABELS[2])
              .otherwise(QUARTILE_LABELS[3]))
    points = q.select(F.struct("p25", "p50", "p75")).scalar()      # one subquery for the three
    return means.withColumn("_q", points).select(*SERIES, "series_mean", label.alias("volume_quartile"))


def top_departments(df: DataFrame, n: int = 10) -> DataFrame:
    """the n departments with the largest total (all-null total counts as 0); a top-k
    over one row per department (each task keeps n rows)."""
    t = df.groupBy("dept_id").agg(F.coalesce(F.sum("weekly_sales"), F.lit(0)).alias("_t"))
    return t.orderBy(F.desc("_t"), F.asc("dept_id")).limit(n).select("dept_id")


def create_segments(actual: DataFrame, top_n: int = 10) -> DataFrame:
    """Actual rows plus volume_quartile (C8: series lookup) and is_top_dept."""
    q = volume_quartiles(actual).select(*SERIES, "volume_quartile")
    top = top_departments(actual, top_n).withColumn("_top", F.lit(True))
    out = actual.join(q, SERIES, "left").join(top, "dept_id", "left")
    return (out.withColumn("is_top_dept", F.when(F.col("_top"), TOP_LABEL).otherwise(OTHER_LABEL))
               .drop("_top"))
