"""Sinks (A4-A8): staging writes, splits, feature tables, metrics, predictions.

Files are Parquet unless a CSV / JSON hand-off is asked for.  Predictions of
many models go to one folder partitioned by ``model``, so reading one model
back prunes the other partitions instead of opening one file per model.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillcast.functions.scalars import safe_name


def append_staging(df: DataFrame, path: str) -> None:
    """A4: staging writes always append."""
    df.write.mode("append").parquet(path)


def truncate_staging(spark: SparkSession, path: str, schema) -> None:
    """A5: replace a staging table by an empty one of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_splits(df_with_split: DataFrame, path: str) -> None:
    """One table partitioned by split (a split read prunes the others), rows sorted
    by (split, store, dept, week) inside each task: the writer needs them by split first and would
    otherwise sort anew, losing the order that keeps row-group statistics selective."""
    (df_with_split.sortWithinPartitions("split", "store_id", "dept_id", "week_date")
        .write.mode("overwrite").partitionBy("split").parquet(path))


#: Buckets of a table that is stored by series.
SERIES_BUCKETS = 16


def _table_name(path: str) -> str:
    return "stored_" + hashlib.md5(path.encode()).hexdigest()


def write_by_series(df: DataFrame, path: str, buckets: int = SERIES_BUCKETS) -> None:
    """A table in ``buckets`` by hash of (store, dept), each sorted by series and week.  Read with
    ``read_by_series``, its layout is known to Spark: windows and aggregates by series need no exchange.
    Each bucket is written by one task, so there is one file a bucket; rows of a series lie together."""
    spark, name = df.sparkSession, _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keys = ["store_id", "dept_id"]
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
       .sortBy(*keys, "week_date").option("path", path).saveAsTable(name))
    # the layout goes with the files: any later session can name it again
    spark.createDataFrame([(buckets, df.schema.json())], "buckets int, schema string").coalesce(1).write.mode("overwrite").json(f"{path}_layout")


def read_by_series(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_by_series`` stored under ``path``, by this or an earlier session."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        layout = spark.read.json(f"{path}_layout").first()
        schema = StructType.fromJson(json.loads(layout["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (store_id, dept_id) "
                  f"SORTED BY (store_id, dept_id, week_date) INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV hand-off (one file per task, no coalesce to one writer)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_predictions(long_predictions: DataFrame, path: str) -> None:
    """(model, keys, predicted_sales) partitioned by a file-safe model name."""
    (long_predictions.withColumn("model_dir", safe_name(F.col("model")))
        .write.mode("overwrite").partitionBy("model_dir").parquet(path))


def read_predictions(spark: SparkSession, path: str, models=None) -> DataFrame:
    """One partitioned read; asked-for models that were never written are simply absent."""
    df = spark.read.parquet(path)
    if models is not None:
        # the folder name prunes partitions; the model name tells names apart that share a folder
        folders = [r[0] for r in spark.createDataFrame([(m,) for m in models], "m string").select(safe_name(F.col("m"))).collect()]
        df = df.where(F.col("model_dir").isin(folders) & F.col("model").isin(list(models)))
    return df.drop("model_dir")
