"""Batch scoring (L21, B20, J3-J4): contract check, typing in stored order, prediction.

Re-aimed from a one-request HTTP service: a batch of feature rows is checked,
quarantined rows keep their reasons, valid rows are typed (bad numbers become
null) and scored by a JVM-side model expression or Spark ML pipeline.  The
caller's row id travels with every row, so order is restored by joining or
sorting on it, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import checks
from tillcast.schemas import MODEL_INPUTS

STRING_INPUTS = {"store_type"}
INT_INPUTS = {"store_id", "dept_id", "store_size", "year", "week_of_year", "month", "day_of_year",
              "is_holiday_prev1", "is_holiday_next1", "within_7days_after_holiday",
              "within_7days_before_holiday", "has_markdown"}
BOOL_INPUTS = {"isholiday"}


def _typed(c: str, there: bool = True) -> F.Column:
    text = (F.col(c) if there else F.lit(None)).cast("string")
    if c in STRING_INPUTS:
        return text
    return text.try_cast("int" if c in INT_INPUTS else "boolean" if c in BOOL_INPUTS else "double")


def type_inputs(df: DataFrame, order=MODEL_INPUTS, row_id: str = "row_id") -> DataFrame:
    """Numeric coercion (bad values to null), categorical as string, stored column order; inputs
    that the batch has no column for are null."""
    return df.select(row_id, *[_typed(c, c in df.columns).alias(c) for c in order])


def unreadable(df: DataFrame, order=MODEL_INPUTS) -> F.Column:
    """Reasons for values that are there but have no reading as their column's type; a store
    type has to be text, so one that reads as a number is refused."""
    lost = [F.when(F.col(c).isNotNull() & _typed(c).isNull(), F.lit(f"{c} unreadable"))
            for c in order if c in df.columns and c not in STRING_INPUTS]
    if "store_type" in df.columns:
        lost.append(F.when(F.col("store_type").try_cast("double").isNotNull(), F.lit("store_type not text")))
    return F.filter(F.array(*lost), lambda x: x.isNotNull())


def score_batch(batch: DataFrame, predict, row_id: str = "row_id"):
    """(scored rows with row_id and predicted_sales, rejected rows with reasons).
    ``predict`` maps a typed frame to (row_id, predicted_sales).  Typing comes before the
    contract: a value that does not parse is a reason of its own row, never a null that passes
    or an error that ends the batch.  ``row_id`` may be a struct of the caller's keys."""
    checks.require_non_empty(batch, "prediction batch")
    typed = type_inputs(batch.withColumn(row_id, F.struct(F.col(row_id).alias("id"), unreadable(batch).alias("junk"))), row_id=row_id)
    judged = typed.withColumn("reasons", F.concat(f"{row_id}.junk", checks.contract_reasons(typed))).withColumn(row_id, F.col(f"{row_id}.id"))
    valid = judged.where(F.size("reasons") == 0).drop("reasons")
    return predict(valid), judged.where(F.size("reasons") > 0).select(row_id, "reasons")
