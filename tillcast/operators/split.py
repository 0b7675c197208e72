"""Chronological split (B9), union / un-union by marker (G1, G2), split counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import DEFAULT, Params


def split_label(date_col: str = "week_date", params: Params = DEFAULT) -> F.Column:
    """Train up to train_end, val up to val_end, test after (edges inclusive)."""
    d = F.col(date_col)
    return (F.when(d <= F.lit(params.train_end).cast("date"), "train")
             .when(d <= F.lit(params.val_end).cast("date"), "val")
             .otherwise("test"))


def with_split(view: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One frame, rows tagged; no shuffle and no row movement."""
    return view.withColumn("split", split_label("week_date", params))


def take_split(df: DataFrame, name: str) -> DataFrame:
    """Rows of one split (a filter, pushed to the scan when written partitioned by split)."""
    return df.where(F.col("split") == name)


def union_splits(**frames: DataFrame) -> DataFrame:
    """G1: bag union with a marker column."""
    out = None
    for name, df in frames.items():
        tagged = df.withColumn("split", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def split_counts(df: DataFrame) -> DataFrame:
    """D33"""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
