"""Upserts of staging into the star schema (K1-K4) as joins: no row-by-row merge.

The merged table is target rows whose key is not staged, plus every staged
row whole (a staged null overwrites a stored value, as INSERT .. ON CONFLICT
DO UPDATE SET col = EXCLUDED.col does).  That is one anti join and one union,
shuffled once on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.schemas import KEYS


def assert_unique_staging(stg: DataFrame, keys=KEYS) -> DataFrame:
    """K4: a key staged twice is an error for an update merge."""
    dup = stg.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    if not dup.isEmpty():
        raise ValueError(f"staging holds duplicate keys on {keys}")
    return stg


def upsert(target: DataFrame, staging: DataFrame, keys, columns) -> DataFrame:
    """K1 / K3: staged row wins whole; unmatched target rows kept; new keys inserted."""
    keep = target.join(staging.select(*keys), keys, "left_anti")
    return keep.select(*columns).unionByName(staging.select(*columns))


def upsert_store(target: DataFrame, staging: DataFrame) -> DataFrame:
    """K1 (K4 checked first): insert or overwrite type and size; two different rows of one store are an error."""
    return upsert(target, assert_unique_staging(staging.distinct(), ["store_id"]), ["store_id"], ["store_id", "store_type", "store_size"])


def insert_missing_depts(target: DataFrame, staging: DataFrame) -> DataFrame:
    """K2: insert new department ids, ignore known ones."""
    new = staging.select("dept_id").distinct().join(target.select("dept_id"), "dept_id", "left_anti")
    return target.select("dept_id").unionByName(new)


def upsert_fact(target: DataFrame, staging: DataFrame, columns) -> DataFrame:
    """K3 (K4 checked first)."""
    return upsert(target, assert_unique_staging(staging), KEYS, columns)
