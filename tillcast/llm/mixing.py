"""Mixing sources to target weights by Pfair scheduling (operator 6).

A source of weight w cut into blocks gives its i-th block (from 1) the release time
floor((i - 1) / w) and the deadline ceil(i / w).  Serving, at each slot, the released block of
the earliest deadline keeps every source within less than one block of w * t at every time t.

Weights are integer parts c of a total C, so the schedule repeats after C slots: the pattern of
one period is found once, on a table of C entries, and block j of a source lands in period
j div c at the pattern's (j mod c)-th place.  A source that runs out ends a phase: the others go
on with their parts of the smaller total.  Documents only ever meet their source's few phase rows.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import free_name
from tillcast.llm.ranks import ranked
from tillcast.session import durable

BLOCK_ROWS = 32
PARTS = 1000
ALPHA = 0.5


def period(parts: dict[str, int]) -> list[str]:
    """The sources of the slots of one period of sum(parts) slots, earliest deadline first;
    ties go to the larger share, then to the name."""
    total = sum(parts.values())
    waiting = [(0, s, 0) for s in sorted(parts)]
    heapq.heapify(waiting)
    ready: list = []
    out = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // parts[s]), -parts[s], s, i))
        _, _, s, i = heapq.heappop(ready)
        out.append(s)
        if i + 1 < parts[s]:
            heapq.heappush(waiting, ((i + 1) * total // parts[s], s, i + 1))
    return out


def phases(rows: dict[str, int], parts: dict[str, int], block_rows: int) -> list[dict]:
    """One entry per source and phase: its blocks first..end (exclusive) go to the slots
    base + (j - first) div c * total + places[(j - first) mod c]; ``short`` is how many rows
    the blocks of earlier phases lack to be full."""
    blocks = {s: -(-n // block_rows) for s, n in rows.items() if n > 0}
    done = dict.fromkeys(blocks, 0)
    out, base, short = [], 0, 0
    while live := sorted(s for s in blocks if done[s] < blocks[s]):
        total = sum(parts[s] for s in live)
        places: dict = {s: [] for s in live}
        for t, s in enumerate(period({s: parts[s] for s in live})):
            places[s].append(t)

        def ends(s):
            left = blocks[s] - done[s] - 1
            return left // parts[s] * total + places[s][left % parts[s]]

        last = min(live, key=ends)
        length = ends(last) + 1
        for s in live:
            took = length // total * parts[s] + sum(p < length % total for p in places[s])
            out.append({"src": s, "first": done[s], "end": done[s] + took, "base": base, "c": parts[s],
                        "total": total, "places": places[s], "short": short})
            done[s] += took
        base += length
        short += blocks[last] * block_rows - rows[last]
    return out


def tempered_parts(rows: dict[str, int], alpha: float = ALPHA, parts: int = PARTS) -> dict[str, int]:
    """Target weights proportional to (rows of the source) ** alpha, as integer parts of about
    ``parts``, at least one each."""
    whole = sum(n ** alpha for n in rows.values())
    return {s: max(1, round(parts * n ** alpha / whole)) for s, n in rows.items()}


def _src(source):
    """A key for the source; a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix_sources(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS,
                alpha: float = ALPHA, parts: int = PARTS, row: list[str] | None = None) -> DataFrame:
    """Place of every row of ``docs(doc_id, source)`` in the mixed order: doc_id, source, block
    (of its source, by doc_id), slot (of the block in the schedule, gapless from 0), position
    (of the row, gapless from 0).

    ``weights``: target weight per source (None as a key: the null source); sources that it does
    not name, or without it all, get parts proportional to rows ** alpha.  No row is dropped:
    when a source runs out the rest keep their proportions.  The plan holds one entry per source
    and phase, whatever the number of rows.

    ``row``: columns that tell rows of equal doc_id apart; they order those and are returned too.

    Null source: a source of its own.  Null doc_id: sorts first in its source.  Repeated rows
    get a place each.  Texts are not read.  No rows: no rows.  Other columns are ignored."""
    spark = docs.sparkSession
    row = row or []
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", _src(F.col("source")).alias("_src"), *row)
    rows = {r[0]: r[1] for r in keys.groupBy("_src").count().collect()}
    schema = ("_s string, first long, end long, base long, c long, total long, places array<int>, short long")
    share = tempered_parts(rows, alpha, parts)
    if weights:
        named = {"" if s is None else "=" + s: w for s, w in weights.items()}
        whole = sum(named.values())
        share |= {s: max(1, round(parts * w / whole)) for s, w in named.items() if s in rows}
    plan = spark.createDataFrame([tuple(p.values()) for p in phases(rows, share, block_rows)], schema)
    r = (ranked(keys, ["_src"], ["doc_id", *row]).withColumn("block", F.floor(F.col("_rank") / block_rows)))
    j = F.col("block") - F.col("first")
    return (r.join(F.broadcast(plan), (F.col("_src") == F.col("_s")) & (F.col("block") >= F.col("first"))
                   & (F.col("block") < F.col("end")))
            .withColumn("slot", F.col("base") + F.floor(j / F.col("c")) * F.col("total")
                        + F.get("places", (j % F.col("c")).cast("int")))
            .withColumn("position", F.col("slot") * block_rows - F.col("short") + F.col("_rank") % block_rows)
            .select("doc_id", "source", "block", "slot", "position", *row))


def in_mixed_order(docs: DataFrame, **how) -> DataFrame:
    """``docs`` sorted by their place in the mix: written out, the files hold it in this order.

    Rows are told apart by where they lie in the files read (by their place in a checkpoint if
    ``docs`` is not read from files), so rows without doc_id and repeated rows are mixed like
    any others.  Only these names and the sources are ranked; the rows meet their places in one join."""
    file, at, place = (free_name(docs, c) for c in ("mix_file", "mix_row", "mix_place"))
    try:
        named = docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    except AnalysisException:
        named = durable(docs.withColumns({file: F.lit(0).cast("long"), at: F.monotonically_increasing_id()}))
    found = mix_sources(named.select("doc_id", "source", file, at), row=[file, at], **how).select(file, at, F.col("position").alias(place))
    return (named.join(found, [file, at]).repartitionByRange(place).sortWithinPartitions(place).select(*docs.columns))
