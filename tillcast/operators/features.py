"""Feature table (L1) in one window pass per scope.

The reference recomputes every window family three times on growing
unions of the splits.  All of them look backward only, so computing them
once over the union with a split marker gives the same values.  Spark then
needs one hash exchange on (store_id, dept_id) and one sort for every lag
and rolling column (E1-E3, E8, E9); the split-scoped holiday flags
(E4-E6) reuse that exchange and add one more sort.  Each window group is a
single series, which has at most one row per week (primary key), so no
window partition can grow with the number of stores or departments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import DEFAULT, Params
from tillcast.functions.scalars import add_markdown_features, add_time_features, handle_negative_sales
from tillcast.functions.stats import doubles, window_mean
from tillcast.schemas import SERIES, feature_columns

def series_window():
    """Built on call: a window spec needs an active session."""
    return Window.partitionBy(*SERIES).orderBy("week_date")


def lag_columns(col: str, lags, prefix: str | None = None, w=None) -> dict:
    """Value ``k`` rows back in the series (rows, not weeks: gaps are not filled)."""
    w = w if w is not None else series_window()
    prefix = prefix if prefix is not None else f"{col}_lag_"
    return {f"{prefix}{k}": F.lag(F.col(col), k).over(w) for k in lags}


def rolling_columns(df: DataFrame, col: str, windows, prefix: str, with_std: bool,
                    w=None) -> dict:
    """Mean (and sample std) of the ``n`` rows before the current one;
    nulls skipped, null when no value (std: when fewer than two)."""
    w = w if w is not None else series_window()
    out = {}
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        out[f"{prefix}rolling_mean_{n}"] = window_mean(df, col, frame)
        if with_std:
            out[f"{prefix}rolling_std_{n}"] = F.stddev_samp(F.col(col)).over(frame)
    return out


def holiday_columns(scope: list[str] | None) -> dict:
    """E4-E6 (scope = split + series keys) and E7 (scope = None: one global date order;
    only for frames with one row per date, e.g. weekly totals)."""
    w = (Window.partitionBy(*scope) if scope else Window).orderBy("week_date")
    prev1 = F.coalesce(F.lag(F.col("isholiday").cast("int"), 1).over(w), F.lit(0))
    next1 = F.coalesce(F.lead(F.col("isholiday").cast("int"), 1).over(w), F.lit(0))
    return {"is_holiday_prev1": prev1, "is_holiday_next1": next1}


def add_holiday_window_features(df: DataFrame, scope: list[str] | None) -> DataFrame:
    df = df.withColumns(holiday_columns(scope))
    return df.withColumns({
        "within_7days_after_holiday": (F.col("is_holiday_prev1") == 1).cast("int"),
        "within_7days_before_holiday": (F.col("is_holiday_next1") == 1).cast("int"),
    })


def build_features(view_with_split: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """L1: the 52 feature columns plus ``split``, over the union of all splits.
    Money and covariates stay exact decimals through the windows; the table is double."""
    df = handle_negative_sales(view_with_split, params.negative_sales_strategy)
    df = add_time_features(df)
    df = add_markdown_features(df)
    backward = {}
    backward.update(lag_columns("weekly_sales", params.lags, prefix="lag_"))
    backward.update(rolling_columns(df, "weekly_sales", params.rolling_windows, "", True))
    for c in params.exogenous:
        if c in df.columns:
            backward.update(lag_columns(c, params.lags))
    for c in params.exogenous:
        if c in df.columns:
            backward.update(rolling_columns(df, c, params.rolling_windows, f"{c}_", False))
    df = df.withColumns(backward)
    df = add_holiday_window_features(df, ["split", *SERIES])
    cols = [c for c in feature_columns(params.lags, params.rolling_windows, params.exogenous)
            if c in df.columns]
    extra = [c for c in ("is_return",) if c in df.columns]
    return doubles(df.select(*cols, *extra, "split"))


# -- L1 for new weeks only ------------------------------------------------------------------------

def context_rows(params: Params = DEFAULT) -> int:
    """Rows of a series that the features of its next row, and of its own last row, can look back on."""
    return max(*params.lags, *params.rolling_windows) + 1


def tail_state(view_with_split: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The last rows of every series: all that later weeks need to know of the past."""
    latest = Window.partitionBy(*SERIES).orderBy(F.desc("week_date"))
    return (view_with_split.withColumn("_at", F.row_number().over(latest)).where(F.col("_at") <= context_rows(params)).drop("_at"))


def restated(state: DataFrame, new: DataFrame) -> DataFrame:
    """New rows that are not later than what their series already has: features after them change, so
    they need a rebuild."""
    last = state.groupBy(*SERIES).agg(F.max("week_date").alias("_last"))
    return new.join(last, SERIES).where(F.col("week_date") <= F.col("_last")).drop("_last")


def appended_features(state: DataFrame, new: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """L1 for rows of later weeks: the features of ``new`` and, since the week after a row says whether
    a holiday follows, of the last old row of each series that goes on.  The windows run over the
    state's rows and the new ones alone; both meet on the series keys, in the windows' own exchange."""
    first_new = new.groupBy(*SERIES).agg(F.min("week_date").alias("_first"))
    last_old = state.groupBy(*SERIES).agg(F.max("week_date").alias("_last"))
    since = first_new.join(last_old, SERIES, "left").select(*SERIES, F.coalesce("_last", "_first").alias("_since"))
    touched = state.join(since.select(*SERIES), SERIES, "left_semi")
    built = build_features(touched.unionByName(new), params)
    return built.join(since, SERIES).where(F.col("week_date") >= F.col("_since")).drop("_since")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count per column in one pass, as (column_name, null_count)."""
    columns = columns or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")
