"""Exact percentiles (linear interpolation, as pandas / numpy / DuckDB quantile_cont)
without sorting or shuffling the values, and without a group's values in one buffer.

Spark's ``percentile`` keeps every distinct value of a group in one buffer on one task, and
``percentile_approx`` is not exact but bounded: the value it gives lies at most n / accuracy ranks
off.  So it serves to find a narrow bracket that must hold the wanted ranks:

1. cut values of each group at CUTS equal steps, by the mergeable sketch (one small row a task);
2. one pass counts, for each wanted rank, the rows below its bracket and the rows of every value
   inside it (about 4 / CUTS of the group), both combined map-side;
3. where a bracket still holds more than MOST rows, its rows are narrowed in the same way;
4. running counts inside the brackets give the two values around each rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import broadcast_if_small, durable

#: Steps between cut values, and the ranks of the sketch: an error of a tenth of a step.
CUTS, ACCURACY = 1_000, 10_000
#: Rows of one bracket that a window may order; more are narrowed first.
MOST = 5_000_000
#: Rows of the bracket table (group x probability) that are broadcast.
MOST_TARGETS = 100_000


def _same(keys, left: str, right: str):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def _brackets(rows: DataFrame, keys: list[str], targets: DataFrame | None, probs) -> DataFrame:
    """keys, prob, lo, hi (wanted ranks among ``rows``), frac, n, least, most (the bracket)."""
    steps = F.array(*[F.lit(k / CUTS) for k in range(CUTS + 1)])
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                                     F.percentile_approx("_v", steps, ACCURACY).alias("_cuts"))
    if targets is None:
        wanted = sketch.withColumn("prob", F.explode(F.array(*[F.lit(p) for p in probs]))).withColumn("_rank", F.col("prob") * (F.col("n") - 1))
        wanted = wanted.withColumns({"lo": F.floor("_rank"), "hi": F.ceil("_rank"), "frac": F.col("_rank") - F.floor("_rank")})
    else:
        wanted = sketch.alias("s").join(targets.alias("t"), _same(keys, "s", "t")).select("s.*", "t.lo", "t.hi", "t.frac")
    # one step of slack on either side; a small group is its own bracket
    low = F.floor(F.col("lo") * CUTS / F.col("n")) - 1
    high = F.floor(F.col("hi") * CUTS / F.col("n")) + 3
    small = F.col("n") <= 10 * CUTS
    return wanted.withColumns({
        "least": F.when(small | (low < 1), F.col("_min")).otherwise(F.get("_cuts", low.cast("int"))),
        "most": F.when(small | (high >= CUTS), F.col("_max")).otherwise(F.get("_cuts", high.cast("int")))}).drop("_cuts", "_min", "_max", "_rank")


def exact_percentiles(df: DataFrame, value: str, probs, by=(), materialized: bool = False) -> DataFrame:
    """Long result: ``by`` columns, ``prob``, ``value`` (double), one row per group and prob.
    Nulls are skipped; a group with no value yields no row.  ``materialized``: ``df`` is
    already a checkpoint (or narrow ops over one), so reading it twice is cheap."""
    by, probs = list(by), [float(p) for p in probs]
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    if not materialized:
        rows = durable(rows)
    keys, targets = by, None
    while True:
        brackets = durable(_brackets(rows, keys, targets, probs))
        keys = [*by, "prob"]
        met = rows.alias("r").join(broadcast_if_small(brackets, MOST_TARGETS).alias("b"),
                                   _same(by if targets is None else keys, "r", "b") & (F.col("_v") <= F.col("most")))
        met = met.select(*[F.col(f"b.{k}").alias(k) for k in keys], "_v", "least")
        largest = brackets.agg(F.max("n")).first()[0]
        if not largest or 4 * largest / CUTS <= MOST:
            break
        # narrower: the rows inside the brackets are the rows of the next turn, ranks count from there
        below = met.groupBy(*keys).agg(F.count_if(F.col("_v") < F.col("least")).alias("_below"))
        targets = durable(brackets.alias("b").join(below.alias("c"), _same(keys, "b", "c"))
                          .select(*[F.col(f"b.{k}").alias(k) for k in keys], (F.col("lo") - F.col("_below")).alias("lo"),
                                  (F.col("hi") - F.col("_below")).alias("hi"), "frac"))
        fewer = durable(met.where(F.col("_v") >= F.col("least")).select(*keys, "_v"))
        if fewer.groupBy(*keys).count().agg(F.max("count")).first()[0] >= largest:      # ties: nothing left to narrow
            met = fewer.withColumn("least", F.col("_v"))
            brackets = targets
            break
        rows = fewer
    # rows below a bracket are one row without a value, which comes first
    inside = met.groupBy(*keys, F.when(F.col("_v") >= F.col("least"), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    spans = inside.withColumn("_end", F.sum("_c").over(running))
    spans = spans.alias("s").join(broadcast_if_small(brackets, MOST_TARGETS).alias("b"), _same(keys, "s", "b")).select(
        "s.*", "b.lo", "b.hi", "b.frac")

    def at(rank):
        return F.max(F.when((F.col("_end") - F.col("_c") <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col("_v")))

    picked = spans.groupBy(*keys).agg(at("lo").alias("_lo"), at("hi").alias("_hi"), F.first("frac").alias("_frac"))
    return picked.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("value"))


def percentile_columns(df: DataFrame, value: str, named_probs: dict, by=(),
                       materialized: bool = False) -> DataFrame:
    """Wide result: one row per group, one column per name in ``named_probs``."""
    long = exact_percentiles(df, value, list(named_probs.values()), by, materialized)
    by = list(by)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(name)
            for name, p in named_probs.items()]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)


def global_positions(df: DataFrame, order_cols, col: str = "_pos") -> DataFrame:
    """0-based position of every row in the total order ``order_cols`` (must be unique),
    without a single-partition window over rows: range-partition, count per partition
    (one row per partition), running offsets over those counts, row number inside each
    partition.  The tagged frame is checkpointed so that a re-run task keeps its partition."""
    order_cols = list(order_cols)
    ranged = durable(df.repartitionByRange(*order_cols).withColumn("_part", F.spark_partition_id()))
    per_part = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_pc"))
    offsets = per_part.select(
        "_part", (F.sum("_pc").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
                  - F.col("_pc")).alias("_off"))
    inner = Window.partitionBy("_part").orderBy(*order_cols)
    return (ranged.withColumn("_rn", F.row_number().over(inner))
                  .join(offsets, "_part")
                  .withColumn(col, F.col("_off") + F.col("_rn") - 1)
                  .drop("_part", "_rn", "_off"))
