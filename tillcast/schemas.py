"""Fixed schemas of the star model, the feature table and the scoring contract."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["store_id", "dept_id", "week_date"]
SERIES = ["store_id", "dept_id"]
MARKDOWNS = ["markdown1", "markdown2", "markdown3", "markdown4", "markdown5"]

# A10: star schema
DIM_STORE = T.StructType([
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("store_type", T.StringType(), True),
    T.StructField("store_size", T.IntegerType(), True),
])
DIM_DEPT = T.StructType([T.StructField("dept_id", T.IntegerType(), False)])


def fact_schema(staging: bool = False) -> T.StructType:
    nullable_keys = staging
    return T.StructType([
        T.StructField("store_id", T.IntegerType(), nullable_keys),
        T.StructField("dept_id", T.IntegerType(), nullable_keys),
        T.StructField("week_date", T.DateType(), nullable_keys),
        T.StructField("weekly_sales", T.DecimalType(12, 2), True),
        T.StructField("isholiday", T.BooleanType(), True),
        T.StructField("temperature", T.DecimalType(6, 2), True),
        T.StructField("fuel_price", T.DecimalType(6, 3), True),
        *[T.StructField(m, T.DecimalType(12, 2), True) for m in MARKDOWNS],
        T.StructField("cpi", T.DecimalType(12, 7) if staging else T.DecimalType(10, 7), True),
        T.StructField("unemployment", T.DecimalType(6, 3), True),
    ])


FACT = fact_schema(False)
FACT_STG = fact_schema(True)

# Analytics view, 16 columns, analytics in double
VIEW_COLUMNS = [
    "store_id", "store_type", "store_size", "dept_id", "week_date", "weekly_sales",
    "isholiday", "temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment",
]

# A1: raw CSV tables, every column a string
RAW_STORES = T.StructType([T.StructField(c, T.StringType()) for c in ["Store", "Type", "Size"]])
RAW_FEATURES = T.StructType([T.StructField(c, T.StringType()) for c in [
    "Store", "Date", "Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3",
    "MarkDown4", "MarkDown5", "CPI", "Unemployment", "IsHoliday"]])
RAW_TRAIN = T.StructType([T.StructField(c, T.StringType()) for c in [
    "Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"]])

TIME_FEATURES = ["week_of_year", "month", "year", "day_of_year"]
HOLIDAY_FEATURES = ["is_holiday_prev1", "is_holiday_next1",
                    "within_7days_after_holiday", "within_7days_before_holiday"]


def feature_columns(lags=(1, 2, 4, 52), windows=(4, 8),
                    exogenous=("markdown_total", "fuel_price", "temperature")) -> list[str]:
    """Column order of the 52-column feature table."""
    cols = list(VIEW_COLUMNS) + TIME_FEATURES + ["markdown_total", "has_markdown"]
    cols += [f"lag_{k}" for k in lags]
    for w in windows:
        cols += [f"rolling_mean_{w}", f"rolling_std_{w}"]
    cols += HOLIDAY_FEATURES
    cols += [f"{c}_lag_{k}" for c in exogenous for k in lags]
    cols += [f"{c}_rolling_mean_{w}" for c in exogenous for w in windows]
    return cols


FEATURE_COLUMNS = feature_columns()
MODEL_INPUTS = [c for c in FEATURE_COLUMNS if c not in ("weekly_sales", "week_date")]

# Scoring row contract
CONTRACT_INT_REQUIRED = ["store_id", "dept_id", "store_size", "year"]
CONTRACT_RANGES = {"week_of_year": (1, 53), "month": (1, 12), "day_of_year": (1, 366)}
CONTRACT_FLAGS = ["is_holiday_prev1", "is_holiday_next1", "within_7days_after_holiday",
                  "within_7days_before_holiday", "has_markdown"]
CONTRACT_DOUBLE_REQUIRED = ["temperature", "fuel_price", "cpi", "unemployment",
                            *MARKDOWNS, "markdown_total"]
CONTRACT_NULLABLE = [c for c in FEATURE_COLUMNS
                     if c.startswith(("lag_", "rolling_")) or "_lag_" in c or "_rolling_" in c]
