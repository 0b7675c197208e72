"""Numbered versions of something in a shared folder, made visible by a marker file.

    <root>/v000003/_CLAIMED      created by the one writer of the version, before anything else
    <root>/v000003/_PUBLISHED    created when everything is written and checked

Readers take the newest version that has its marker, so what a failed writer left is never read."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

CLAIMED, PUBLISHED = "_CLAIMED", "_PUBLISHED"


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system itself: an error on reading a table is never taken for its absence."""
    fs, p = file_system(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[1:]) for n in children(spark, root) if n[:1] == "v" and n[1:].isdigit()]


def folder(root: str, version: int, *parts: str) -> str:
    return os.path.join(root, f"v{version:06d}", *parts)


def newest(spark: SparkSession, root: str) -> int:
    """The newest published version, 0 if there is none."""
    return max((n for n in numbers(spark, root) if exists(spark, folder(root, n, PUBLISHED))), default=0)


def claim(spark: SparkSession, root: str) -> int:
    """A version number of its own for one writer: two at once never write the same folder."""
    n = max(numbers(spark, root), default=0) + 1
    while True:
        fs, p = file_system(spark, folder(root, n, CLAIMED))
        fs.mkdirs(p.getParent())
        if fs.createNewFile(p):
            return n
        n += 1


def publish(spark: SparkSession, root: str, version: int) -> None:
    fs, marker = file_system(spark, folder(root, version, PUBLISHED))
    fs.create(marker, True).close()
