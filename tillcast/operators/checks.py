"""Data-quality checks.

Every check is an aggregate over the tables; the suite is one small frame
(check, passed, severity, value).  Date range and value range only warn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillcast.schemas import (CONTRACT_DOUBLE_REQUIRED, CONTRACT_FLAGS, CONTRACT_INT_REQUIRED,
                              CONTRACT_RANGES, FACT, KEYS)
from tillcast.session import broadcast_if_small

CHECK_SCHEMA = "check string, passed boolean, severity string, value string"


def _row(name: str, passed: F.Column, severity: str, value: F.Column) -> list[F.Column]:
    return [F.lit(name).alias("check"), passed.alias("passed"), F.lit(severity).alias("severity"),
            value.cast("string").alias("value")]


def row_count_check(df: DataFrame, name: str, expected: int | None = None) -> DataFrame:
    """Count equals ``expected`` (any non-empty table when None)."""
    n = F.count(F.lit(1))
    ok = (n == expected) if expected is not None else (n > 0)
    return df.agg(*_row(f"row_count_{name}", ok, "error", n))


CRITICAL = [*KEYS, "weekly_sales"]


def null_check(df: DataFrame, cols=CRITICAL) -> DataFrame:
    """No null in the critical columns (one pass for all of them)."""
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in cols])
    return df.agg(*_row("null_values", nulls == 0, "error", nulls))


def duplicate_key_check(df: DataFrame, keys=KEYS) -> DataFrame:
    """No key group with more than one row."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    n = F.count(F.lit(1))
    return g.agg(*_row("duplicate_keys", n == 0, "error", n))


def orphans(fact: DataFrame, dim: DataFrame, key: str, max_dim_rows: int = 100_000) -> DataFrame:
    """Fact rows whose key has no dimension row.  The key column of the dimension is
    broadcast after a size check, so the fact is not shuffled on a low-cardinality key."""
    return fact.join(broadcast_if_small(dim.select(key), max_dim_rows), key, "left_anti")


def foreign_key_check(fact: DataFrame, dim_store: DataFrame, dim_dept: DataFrame) -> DataFrame:
    """Both foreign keys."""
    o = orphans(fact, dim_store, "store_id").select(F.lit(1).alias("_o")).unionByName(
        orphans(fact, dim_dept, "dept_id").select(F.lit(1).alias("_o")))
    n = F.count(F.lit(1))
    return o.agg(*_row("foreign_keys", n == 0, "error", n))


def date_range_check(df: DataFrame) -> DataFrame:
    """First and last date; warns only."""
    v = F.concat_ws(" .. ", F.min("week_date").cast("string"), F.max("week_date").cast("string"))
    return df.agg(*_row("date_range", F.lit(True), "warning", v))


def value_range_check(df: DataFrame, col: str = "weekly_sales") -> DataFrame:
    """Negative values counted; warns only."""
    return df.agg(*_row("negative_values", F.lit(True), "warning", F.count_if(F.col(col) < 0)))


def view_count_check(view: DataFrame, fact: DataFrame) -> DataFrame:
    """D1 for the view: as many rows as the fact, so the dimension joins neither lose nor multiply rows."""
    n = F.count(F.lit(1))
    return view.agg(*_row("row_count_view", n == fact.agg(n).scalar(), "error", n))


#: What the suite asks of the fact; profiles of disjoint sets of keys add up.
PROFILE_SUMS = ("n_rows", "nulls", "duplicates", "orphans", "negatives", "view_rows")


def fact_profile(fact: DataFrame, dim_store: DataFrame, dim_dept: DataFrame, by=(), max_dim_rows: int = 100_000) -> DataFrame:
    """Everything the suite asks of the fact, in one pass over it: rows, nulls in the critical columns,
    key groups with more than one row, orphans of either dimension, negative sales, rows of the view,
    first and last week; one row per ``by`` (one in all without).

    Rows are combined by key first, which is what counts duplicates; the dimensions then meet one
    row a key, broadcast after a size check."""
    by, one = list(by), F.count(F.lit(1))
    keyed = (fact.groupBy(*by, *KEYS).agg(one.alias("_n"), F.count_if(F.col("weekly_sales").isNull()).alias("_no_sales"),
                                          F.count_if(F.col("weekly_sales") < 0).alias("_negative"))
             .join(broadcast_if_small(dim_store.groupBy("store_id").agg(one.alias("_stores")), max_dim_rows), "store_id", "left")
             .join(broadcast_if_small(dim_dept.groupBy("dept_id").agg(one.alias("_depts")), max_dim_rows), "dept_id", "left"))
    n, absent = F.col("_n"), lambda c: F.col(c).isNull().cast("long")
    sums = {"n_rows": n, "nulls": n * reduce(lambda a, b: a + b, map(absent, KEYS)) + F.col("_no_sales"),
            "duplicates": (n > 1).cast("long"), "orphans": n * (absent("_stores") + absent("_depts")), "negatives": F.col("_negative"),
            "view_rows": n * F.coalesce("_stores", F.lit(0)) * F.coalesce("_depts", F.lit(0))}
    return keyed.groupBy(*by).agg(*[F.coalesce(F.sum(e), F.lit(0)).alias(c) for c, e in sums.items()],
                                  F.min("week_date").alias("first_week"), F.max("week_date").alias("last_week"))


def total_profile(profiles: DataFrame) -> DataFrame:
    """One profile from those of disjoint sets of keys."""
    return profiles.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PROFILE_SUMS],
                        F.min("first_week").alias("first_week"), F.max("last_week").alias("last_week"))


def suite_rows(profile: DataFrame, n_stores: F.Column, n_depts: F.Column, expected: dict | None = None,
               n_view: F.Column | None = None) -> DataFrame:
    """The checks as rows of (check, passed, severity, value), from the one row of ``profile``."""
    expected = expected or {}

    def counted(name, n):
        want = expected.get(name)
        return (f"row_count_{name}", n == want if want is not None else n > 0, "error", n)

    def none(name, c):
        return (name, F.col(c) == 0, "error", F.col(c))

    checks = [counted("dim_store", n_stores), counted("dim_dept", n_depts), counted("fact", F.col("n_rows")),
              *([("row_count_view", n_view == F.col("n_rows"), "error", n_view)] if n_view is not None else []),
              none("null_values", "nulls"), none("duplicate_keys", "duplicates"), none("foreign_keys", "orphans"),
              ("date_range", F.lit(True), "warning", F.concat_ws(" .. ", F.col("first_week").cast("string"), F.col("last_week").cast("string"))),
              ("negative_values", F.lit(True), "warning", F.col("negatives"))]
    rows = F.array(*[F.struct(F.lit(name).alias("check"), passed.alias("passed"), F.lit(severity).alias("severity"),
                              value.cast("string").alias("value")) for name, passed, severity, value in checks])
    return profile.select(F.explode(rows).alias("_c")).select("_c.*")


def validation_suite(fact: DataFrame, dim_store: DataFrame, dim_dept: DataFrame,
                     expected: dict | None = None, view: DataFrame | None = None) -> DataFrame:
    """Row counts (with ``view`` also its own), nulls, duplicates, foreign keys, date range, value range."""
    n = F.count(F.lit(1))
    return suite_rows(fact_profile(fact, dim_store, dim_dept), dim_store.agg(n).scalar(), dim_dept.agg(n).scalar(), expected,
                      None if view is None else view.agg(n).scalar())


def suite_summary(results: DataFrame) -> DataFrame:
    """J1 summary: passed / total and the overall flag (warnings never fail)."""
    return results.agg(F.count_if(F.col("passed")).alias("n_passed"), F.count(F.lit(1)).alias("n_checks"),
                       F.bool_and(F.col("passed") | (F.col("severity") == "warning")).alias("all_passed"))


def contract_reasons(df: DataFrame) -> F.Column:
    """Array of rule violations of a scoring row (empty when valid).  A required field that the
    batch has no column for is missing in every row, as a request without it would be refused."""
    def field(c):
        return F.col(c) if c in df.columns else F.lit(None)

    rules = []
    for c in [*CONTRACT_INT_REQUIRED, "store_type", "isholiday"]:
        rules.append(F.when(field(c).isNull(), F.lit(f"{c} required")))
    for c, (lo, hi) in CONTRACT_RANGES.items():
        rules.append(F.when(field(c).isNull() | (field(c) < lo) | (field(c) > hi), F.lit(f"{c} outside {lo}-{hi}")))
    for c in CONTRACT_FLAGS:
        rules.append(F.when(field(c).isNull() | ~field(c).isin(0, 1), F.lit(f"{c} not 0/1")))
    for c in CONTRACT_DOUBLE_REQUIRED:
        rules.append(F.when(field(c).isNull(), F.lit(f"{c} required")))
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def apply_contract(df: DataFrame):
    """J3 re-aimed as batch quarantine: (valid rows, rejected rows with reasons)."""
    r = df.withColumn("reasons", contract_reasons(df))
    return (r.where(F.size("reasons") == 0).drop("reasons"), r.where(F.size("reasons") > 0))


def require_non_empty(df: DataFrame, what: str = "batch") -> DataFrame:
    """An empty batch is an error (a one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"{what} must not be empty")
    return df


#: Whole digits that each numeric column of the fact can hold (precision less scale).
WHOLE_DIGITS = {f.name: f.dataType.precision - f.dataType.scale for f in FACT.fields
                if isinstance(f.dataType, DecimalType)}


def staging_range_violations(stg: DataFrame) -> DataFrame:
    """Staged rows that the fact's NOT NULL keys or numeric precisions would refuse, with reasons."""
    wide = [F.when(F.abs(F.col(c)) >= 10 ** digits, F.lit(f"{c} out of range"))
            for c, digits in WHOLE_DIGITS.items() if c in stg.columns]
    reasons = F.filter(F.array(
        F.when(F.col("store_id").isNull() | F.col("dept_id").isNull() | F.col("week_date").isNull(),
               F.lit("null key")), *wide),
        lambda x: x.isNotNull())
    return stg.withColumn("reasons", reasons).where(F.size("reasons") > 0)
