"""Audit of document filters over all their orders (operator 13).

Which filter removes a document depends on the order only through the first filter in it that
the document fails.  Documents are therefore counted by the set of filters they fail (their
mask).  Of the 120 orders in lexicographic order, those that begin with the same letters lie side
by side, so the orders in which a mask goes at a given step are a few intervals of ranks (Lehmer
code).  Each mask adds its counts at the first rank of an interval and takes them away behind the
last; a running sum over the ranks gives what every order removes at every step.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
#: Rows without doc_id meet no label: so many salts keep them apart in the join.
NULL_SALTS = 256
WORD_BREAKS = r"[\x20\x09-\x0D]+"


def text_mask(text: Column) -> Column:
    """Bits of the filters A (1), B (2), C (4), D (8) that ``text`` fails; null counts as empty.

    A: fewer than 200 words.  B: fewer distinct words than half the words.  C: more than 2 % of
    the code points are A-Z.  D: holds one of ``#$%&*|``."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, WORD_BREAKS), lambda w: w != "")
    upper = F.length(whole) - F.length(F.regexp_replace(whole, "[A-Z]+", ""))
    bits = [(F.size(words) < 200, 1), (100 * F.size(F.array_distinct(words)) < 50 * F.size(words), 2),
            (100 * upper > 2 * F.length(whole), 4), (whole.rlike("[#$%&*|]"), 8)]
    return sum((F.when(fails, bit).otherwise(0) for fails, bit in bits[1:]), F.when(bits[0][0], 1).otherwise(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, those of quality 1 and those of toxic 1, by source
    and set of failed filters.

    A document is a copy (bit E, 16) if some document of smaller doc_id has the same text; rows
    without doc_id are no copies of anything, nor is one row of another with the same doc_id.
    Several labels of one doc_id count as one that is good, or toxic, if any is.

    Rows with the same doc_id, text and source are one row with a count from the start.  Rows of one
    text shrink to one per source and label with the first doc_id there, so the last grouping by
    text holds no more rows than sources and labels, however many copies there are."""
    text = F.coalesce("text", F.lit(""))
    rows = (docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.md5(text)).alias("copy_of"),
                        text_mask(F.col("text")).alias("mask"))
            .groupBy("doc_id", "part", "copy_of", "mask").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("copy_of", "part"), F.lit(NULL_SALTS)))
                        .otherwise(0).cast("long")))
    said = (labels.where("doc_id is not null").groupBy("doc_id")
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
            .withColumn("salt", F.lit(0).cast("long")))
    labelled = rows.join(said, ["doc_id", "salt"], "left").na.fill(0, ["good", "toxic"])
    groups = (labelled.groupBy("copy_of", "mask", "part", "good", "toxic")
              .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
                   F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")))
    earliest = F.min("first.doc_id").over(Window.partitionBy("copy_of"))
    originals = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("earliest"), F.col("first.n")).otherwise(0)
    split = (groups.withColumn("earliest", earliest).withColumn("originals", originals)
             .select("part", "good", "toxic", F.explode(F.array(
                 F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")),
                 F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("originals")).alias("n")))).alias("m")))
    return (split.where("m.n > 0").groupBy("part", F.col("m.mask").alias("mask"))
            .agg(F.sum("m.n").alias("n"), F.sum(F.col("m.n") * F.col("good")).alias("good"),
                 F.sum(F.col("m.n") * F.col("toxic")).alias("toxic")))


def orders() -> list[str]:
    """The orders of the filters in lexicographic order: the place in the list is the rank."""
    return ["".join(p) for p in permutations(FILTERS)]


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last): the orders in which documents of the mask go
    at that step.  One interval for each beginning whose last letter alone is in the mask."""
    out, n = [], len(FILTERS)
    for mask in range(1, 2 ** n):
        failed = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        for step in range(1, n + 1):
            wide = factorial(n - step)
            for first, order in enumerate(orders()[::wide]):
                if order[step - 1] in failed and not failed & set(order[:step - 1]):
                    out.append((mask, step, first * wide, (first + 1) * wide))
    return out


def audit(counts: DataFrame) -> DataFrame:
    """Every (part, filter_order, step) of ``mask_counts``: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.  A part has 600 rows here, so all shuffles but the first are
    small; the intervals (840) and orders (120) are fixed and broadcast."""
    spark: SparkSession = counts.sparkSession
    spans = F.broadcast(spark.createDataFrame(removal_intervals(), "mask int, step int, lo int, hi int"))
    named = F.broadcast(spark.createDataFrame(list(enumerate(orders())), "rank int, filter_order string"))
    what = ["n", "good", "toxic"]
    ends = (counts.join(spans, "mask")
            .select("part", "step", F.explode(F.array(
                F.struct(F.col("lo").alias("rank"), *what),
                F.struct(F.col("hi").alias("rank"), *[(-F.col(c)).alias(c) for c in what]))).alias("e"))
            .select("part", "step", "e.*").where(F.col("rank") < ORDERS))
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.col("mask").bitwiseAND(2 ** i) != 0, F.col("n")).otherwise(0)).alias(f"fails_{f}") for i, f in enumerate(FILTERS)],
        *[F.sum(F.when(F.col("mask") == 2 ** i, F.col("n")).otherwise(0)).alias(f"only_{f}") for i, f in enumerate(FILTERS)])
    steps = (totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
             .select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"),
                     *[F.lit(0).cast("long").alias(c) for c in what]))
    changes = ends.unionByName(steps).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in what])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = changes.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in what])
    rows = (removed.join(named, "rank").join(totals, "part")
            .withColumn("letter", F.expr("substring(filter_order, step, 1)")))

    def of(prefix):
        return F.coalesce(*[F.when(F.col("letter") == f, F.col(f"{prefix}_{f}")) for f in FILTERS])

    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
                       F.col("n").alias("removed"), (of("fails") - F.col("n")).alias("redundant"), of("only").alias("unique_fails"),
                       F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
                       F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``, by source.  An empty table gives no rows; null
    sources and empty ones are one part; documents without a label are neither good nor toxic;
    other columns are not read."""
    return audit(mask_counts(docs, labels))
