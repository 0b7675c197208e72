"""Raw CSV sources (A1, A2) and text renderings of tables.

CSV is read with an explicit all-string schema (no inference pass over the
files); typing happens in the ingest operators with try-casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.scalars import normalise_columns
from tillcast.schemas import MARKDOWNS, RAW_FEATURES, RAW_STORES, RAW_TRAIN, VIEW_COLUMNS


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1: headered CSV, every column a string, names normalised (B1)."""
    df = spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").csv(path)
    return normalise_columns(df)


def read_raw_tables(spark: SparkSession, stores: str, features: str, train: str):
    return (read_raw_csv(spark, stores, RAW_STORES), read_raw_csv(spark, features, RAW_FEATURES),
            read_raw_csv(spark, train, RAW_TRAIN))


def split_schema() -> T.StructType:
    """A2: schema of a split file (the 16 view columns, analytics types)."""
    types = {"store_id": T.IntegerType(), "store_type": T.StringType(), "store_size": T.IntegerType(),
             "dept_id": T.IntegerType(), "week_date": T.DateType(), "isholiday": T.BooleanType()}
    return T.StructType([T.StructField(c, types.get(c, T.DoubleType())) for c in VIEW_COLUMNS])


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2: a split written as CSV, read back with dates parsed by the schema."""
    return (spark.read.schema(split_schema()).option("header", "true")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


# -- raw-looking string frames derived from the star schema -------------------------------------
# The spellings used for the holiday flag in the raw tables
FLAG_SPELLINGS = (("TRUE", "FALSE"), ("true", "false"), ("1", "0"), ("True", "False"))


def _flag_text(flag: F.Column, selector: F.Column) -> F.Column:
    out = None
    for i, (t, f) in enumerate(FLAG_SPELLINGS):
        val = F.when(flag, F.lit(t)).when(~flag, F.lit(f))
        out = F.when(selector == i, val) if out is None else out.when(selector == i, val)
    return out


def _num_text(c: F.Column) -> F.Column:
    return F.coalesce(c.cast("string"), F.lit("NA"))


def raw_from_view(view: DataFrame):
    """(stores, features, train) as all-string frames with the raw headers, derived
    from the analytics view: markdown nulls as 'NA', holiday flags spelled four ways."""
    sel = (F.col("store_id") + F.col("dept_id")) % len(FLAG_SPELLINGS)
    train = view.select(
        F.col("store_id").cast("string").alias("Store"), F.col("dept_id").cast("string").alias("Dept"),
        F.date_format("week_date", "yyyy-MM-dd").alias("Date"),
        _num_text(F.col("weekly_sales")).alias("Weekly_Sales"),
        _flag_text(F.col("isholiday"), sel).alias("IsHoliday"))
    per_store_week = view.groupBy("store_id", "week_date", "isholiday").agg(
        *[F.min(c).alias(c) for c in ["temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment"]])
    features = per_store_week.select(
        F.col("store_id").cast("string").alias("Store"), F.date_format("week_date", "yyyy-MM-dd").alias("Date"),
        _num_text(F.col("temperature")).alias("Temperature"), _num_text(F.col("fuel_price")).alias("Fuel_Price"),
        *[_num_text(F.col(m)).alias(f"MarkDown{i}") for i, m in enumerate(MARKDOWNS, start=1)],
        _num_text(F.col("cpi")).alias("CPI"), _num_text(F.col("unemployment")).alias("Unemployment"),
        _flag_text(F.col("isholiday"), F.col("store_id") % len(FLAG_SPELLINGS)).alias("IsHoliday"))
    stores = view.groupBy("store_id").agg(F.min("store_type").alias("t"), F.min("store_size").alias("s")).select(
        F.col("store_id").cast("string").alias("Store"), F.col("t").alias("Type"),
        F.col("s").cast("string").alias("Size"))
    return normalise_columns(stores), normalise_columns(features), normalise_columns(train)
