"""Database view scan (A3): the analytics view read over JDBC in parallel slices.

A single-connection JDBC read funnels the whole table through one task; the
partitioned form opens ``num_partitions`` connections, each reading one range of
``partition_column``.  Filters and the column list are pushed into the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_view(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int = 1) -> DataFrame:
    reader = spark.read.option("pushDownPredicate", "true")
    if partition_column is None:
        return reader.jdbc(url, table, properties=properties)
    return reader.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                       numPartitions=num_partitions, properties=properties)
