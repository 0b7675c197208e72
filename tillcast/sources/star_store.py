"""The stored star schema: versions, month folders of the fact, staging batches (A4, A5, A10, K1-K4).

    star/fact/load=000002/month=1998-03/   rows that load 2 wrote for that month
    star/v000002/manifest                  the folder of every month in version 2, with its profile
    star/v000002/dim_store, dim_dept       the dimensions, whole
    star/v000002/_CLAIMED, _PUBLISHED      empty markers

A load rewrites the months that it touches and no other: the manifest of the new version names the
new folders for those and the old ones for the rest.  Folders are never changed once written, so
a reader of any version is undisturbed.  A version is claimed by creating a file that must not
exist yet, and published only if the version it was made from is still the newest."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.checks import PROFILE_SUMS
from tillcast.schemas import DIM_DEPT, DIM_STORE, FACT
from tillcast.sources import versions

MANIFEST = T.StructType([
    T.StructField("month", T.StringType()), T.StructField("load", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in PROFILE_SUMS],
    T.StructField("first_week", T.DateType()), T.StructField("last_week", T.DateType())])
#: Staged numbers stay doubles: the range check sees them before the fact's decimals do.
STAGING = {
    "dim_store_stg": DIM_STORE, "dim_dept_stg": DIM_DEPT,
    "fact_stg": T.StructType([T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType)
                              for f in FACT.fields])}
BATCH = "batch"


def month_of(c="week_date"):
    return F.date_format(c, "yyyy-MM")


def _root(out: str) -> str:
    return os.path.join(out, "star")


def folder(out: str, version: int, *parts: str) -> str:
    return versions.folder(_root(out), version, *parts)


def published(spark: SparkSession, out: str) -> int:
    """The newest published version, 0 if there is none."""
    return versions.newest(spark, _root(out))


def claim(spark: SparkSession, out: str) -> int:
    return versions.claim(spark, _root(out))


def publish(spark: SparkSession, out: str, version: int, base: int) -> None:
    """Make ``version`` the newest one; an error if another load has been published since ``base``."""
    now = published(spark, out)
    if now != base:
        raise ValueError(f"version {now} was published while {version} was made from {base}: load again")
    versions.publish(spark, _root(out), version)


def manifest(spark: SparkSession, out: str, version: int) -> DataFrame:
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(folder(out, version, "manifest"))


def read_fact(spark: SparkSession, out: str, version: int, months: list[str] | None = None) -> DataFrame:
    """The fact of a version; with ``months`` the folders of those alone.  The driver lists one
    folder a month."""
    entries = manifest(spark, out, version).select("month", "load")
    if months is not None:
        entries = entries.where(F.col("month").isin(months))
    paths = [os.path.join(out, "star", "fact", f"load={r.load:06d}", f"month={r.month}") for r in entries.orderBy("month").collect()]
    return spark.read.schema(FACT).parquet(*paths) if paths else spark.createDataFrame([], FACT)


def write_fact(rows: DataFrame, out: str, load: int) -> None:
    """Rows of the touched months as the folders of ``load``.  Dealt by range of month and series: a
    month of many rows is many tasks' work, and a task writes few folders, in series order."""
    (rows.withColumn("month", month_of()).repartitionByRange("month", "store_id", "dept_id", "week_date")
         .sortWithinPartitions("month", "store_id", "dept_id", "week_date")
         .write.mode("overwrite").partitionBy("month").parquet(os.path.join(out, "star", "fact", f"load={load:06d}")))


def read_load(spark: SparkSession, out: str, load: int) -> DataFrame:
    """What a load wrote, with its ``month``."""
    return spark.read.schema(T.StructType([*FACT.fields, T.StructField("month", T.StringType())])).parquet(
        os.path.join(out, "star", "fact", f"load={load:06d}"))


def stage(df: DataFrame, out: str, name: str, batch: str) -> None:
    """A4: append the rows of one batch to a staging table.  A batch staged again replaces itself, so a
    load that is repeated, or a task that is run twice, counts once."""
    schema = STAGING[name]
    (df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], F.lit(batch).alias(BATCH))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(_staging(out, name)))


def staged(spark: SparkSession, out: str, name: str) -> DataFrame:
    """All batches of a staging table; none if nothing was staged since it was cleared."""
    path = _staging(out, name)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in STAGING[name].fields])
    if not versions.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])).parquet(path).drop(BATCH)


def clear_staging(spark: SparkSession, out: str) -> None:
    """A5: empty the three staging tables, before a load and after its merge."""
    for name in STAGING:
        fs, p = versions.file_system(spark, _staging(out, name))
        if fs.exists(p):
            fs.delete(p, True)


def _staging(out: str, name: str) -> str:
    return os.path.join(out, "staging", name)
