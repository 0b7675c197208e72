"""Bounded samples of labelled rows for fitting small models on the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def crc_of(col: str) -> Column:
    """crc32 of a value written as text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


SPACE = 1 << 30


def hash_share(key: Column, label: Column, sizes: dict, most: int) -> Column:
    """Whether a row is among a hash share of its label's rows that is expected to hold ``most``
    of ``sizes[label]``: what is kept does not grow with the input."""
    keep = F.lit(False)
    for value, n in sizes.items():
        keep = keep | ((label == F.lit(value)) & (F.pmod(key, F.lit(SPACE)) < F.lit(math.ceil(SPACE * min(1.0, most / max(1, n))))))
    return keep


def labelled_sample(rows: DataFrame, label: str, per_label: int, most_chars: int, whole: bool = False) -> list:
    """At most ``per_label`` different texts of each label, chosen by a hash of the text (so the
    same on any partitioning), with about per_label * most_chars characters of a label at most.
    Texts of any length teach: of one of more than ``most_chars`` characters a passage of that many
    is taken, from a place that the hash chooses; ``whole`` takes whole texts, fewer when they are
    long, but one at least.  A hash share of about twice as many is taken first, which bounds what
    is shuffled and collected, whatever the input.  Returns (label, key, text) rows."""
    keyed = rows.where(F.length("text") > 0).select("text", label, F.xxhash64("text").alias("_key"))
    budget, sizes = per_label * most_chars, {}
    for value, n, mean in keyed.groupBy(label).agg(F.approx_count_distinct("_key"), F.avg(F.length("text"))).collect():
        sizes[value] = n * max(1.0, mean * per_label / budget) if whole else n
    few = keyed.where(hash_share(F.col("_key"), F.col(label), sizes, 2 * per_label))
    if not whole:
        places = F.greatest(F.lit(1), F.length("text") - most_chars + 1)
        start = (F.pmod(F.xxhash64("_key"), places) + 1).cast("int")
        few = few.withColumn("text", F.substring("text", start, F.lit(most_chars)))
    few = few.groupBy(label, "_key").agg(F.min("text").alias("text"))
    w = Window.partitionBy(label).orderBy(F.xxhash64("_key"), "_key")
    before = F.sum(F.length("text")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("text")
    return sorted(few.withColumn("_rank", F.row_number().over(w)).withColumn("_before", before)
                  .where((F.col("_rank") <= per_label) & (F.col("_before") < budget))
                  .select(label, "_key", "text").collect())
