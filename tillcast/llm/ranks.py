"""Ranks and running sums in a total order without one task holding a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import durable


def ranked(df: DataFrame, group: list[str], order: list[str], value: str | None = None) -> DataFrame:
    """``df`` with ``_rank`` (0-based, in its group, by ``order``) and, if ``value`` is given,
    ``_before`` (sum of ``value`` over the group's earlier rows).

    Rows are range-partitioned by (group, order), so a hot group spreads over many
    partitions; each partition ranks its own rows and adds the totals of the group's earlier
    partitions (one row per partition and group).  The tagged rows are checkpointed: a re-run
    task finds the same partition."""
    amount = F.col(value) if value else F.lit(1)
    tagged = durable(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    totals = tagged.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_v"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_v0"))
    offsets = durable(offsets)
    own = Window.partitionBy("_part", *group).orderBy(*order)
    rows = tagged.withColumn("_rank", F.row_number().over(own) - 1)
    if value:
        running = own.rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_before", F.coalesce(F.sum(amount).over(running), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = rows.join(offsets, same).withColumn("_rank", F.col("_rank") + F.col("_n0"))
    if value:
        out = out.withColumn("_before", F.col("_before") + F.col("_v0"))
    return out.drop("_part", "_p", "_n0", "_v0", *[f"_g{i}" for i in range(len(group))])
