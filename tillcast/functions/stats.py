"""Aggregate expressions shared by operators.

Money and covariates are exact decimals.  Their means are taken as an exact
decimal sum divided by the count, so the result does not depend on the order
in which partitions or window rows are added (a double sum does).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_decimal(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.DecimalType)


def exact_mean(c: Column) -> Column:
    """Mean of a decimal column: exact sum, one rounding to double, one division."""
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)


def mean_of(df: DataFrame, col: str) -> Column:
    return exact_mean(F.col(col)) if is_decimal(df, col) else F.avg(F.col(col))


def window_mean(df: DataFrame, col: str, frame) -> Column:
    c = F.col(col)
    if is_decimal(df, col):
        n = F.count(c).over(frame)
        return F.when(n > 0, F.sum(c).over(frame).cast("double") / n)
    return F.avg(c).over(frame)


def doubles(df: DataFrame, cols=None) -> DataFrame:
    """Cast decimal columns (all, or ``cols``) to double, keeping column order."""
    cols = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) and (cols is None or f.name in cols):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
