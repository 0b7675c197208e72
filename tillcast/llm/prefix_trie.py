"""Prefix trie of conversations (operator 12).

Every turn gets an id, the digest of role and text; the texts themselves are read once and never
shuffled.  A conversation is cut into blocks of BLOCK turns, and a block is one row with the ids
in positional columns t0, t1, ... .  A ROLLUP over these columns groups all prefixes of the block
at once, grouping_id() telling their lengths.  A block is keyed by the node that the block before
it ends in, so long conversations go on in further rows of the same grouping and not in more
columns.

What a node needs from its whole subtree comes from its members.  A node belongs to its smallest
member, so a conversation owns an unbroken run of nodes down to where it ends.  Let T be the sum
of a value over the nodes that a conversation owns: the sum over a node's subtree is the sum of T
over its members, less what its owner owns above it.  That sum is a second ROLLUP.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillcast.llm.ranks import ranked
from tillcast.session import durable

BLOCK = 8
#: A conversation takes its first crc32(conv_id) % HEADS turns from the first one of its FAMILY.
HEADS = 6
FAMILY = 100
#: Turns of a conversation in one cell of a join, so that a very long one is many cells.
STRIDE = 4096
#: Blocks whose running prefix is taken in one go.
SPAN = 512
#: Ids in one piece of a list that is digested.
PIECE = 4096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "x1", "x2"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, chars): the turns in order, pos from 0.  Null turns come first; turns of
    one number follow each other by role and digest of the text; rows without conv_id belong to no
    conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"), F.md5(text).alias("tie"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.length(text).cast("long").alias("chars"))
    return (ranked(rows, ["conv_id"], ["turn", "role", "tie"])
            .select("conv_id", F.col("_rank").cast("long").alias("pos"), "id", "chars"))


def _heads(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id, chars, len): every conversation with its first turns taken from the first
    conversation of its family, and ``len`` its number of turns.  Each conversation has one more row
    without id at place 0 if nothing is taken over, so that none without turns is lost."""
    heads = (turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "id", "chars"))).alias("head")))   # at most HEADS - 1 turns
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", _heads(F.col("conv_id")))
             .withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
             .withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,id:binary,chars:bigint>>")),
                                         F.lit(1), F.col("h").cast("int"))))
    convs = durable(convs.withColumn("taken", F.size("head").cast("long"))
                    .withColumn("len", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    taken = convs.select("conv_id", "len", F.explode_outer("head").alias("t")).select(
        "conv_id", F.coalesce("t.pos", F.lit(0)).alias("pos"), "t.id", "t.chars", "len")
    cells = convs.where("n > h").select("conv_id", "taken", "len", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / STRIDE))).alias("cell"))
    own = (turns.withColumn("h", _heads(F.col("conv_id"))).where("pos >= h").withColumn("cell", F.floor(F.col("pos") / STRIDE))
           .join(cells, ["conv_id", "cell"])
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "chars", "len"))
    return taken.unionByName(own)


def _lane(i: int, pos: Column, turn: Column) -> Column:
    """One of the two 64-bit halves of a turn's part in the name of a prefix; none without a turn."""
    return F.coalesce(F.when(turn.isNotNull(), F.xxhash64(F.lit(i), pos.cast("long"), turn)), F.lit(0).cast("long"))


def blocks_of(turns: DataFrame) -> DataFrame:
    """(conv_id, block, len, k1, k2, t0.., c0..): one row per BLOCK turns of a rebuilt conversation.
    (k1, k2) names the node before the block: the exclusive or of a 128-bit hash of every earlier
    (place, turn).  It is taken in two steps, over spans and inside them, so that a conversation of
    any length is many tasks' work."""
    slot = F.col("pos") % BLOCK
    cells = (turns.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("conv_id", "block").agg(
        F.max("len").alias("len"),
        *[F.bit_xor(_lane(i, F.col("pos"), F.col("id"))).alias(f"own{i}") for i in (1, 2)],
        *[F.max(F.when(slot == s, F.col("id"))).alias(f"t{s}") for s in range(BLOCK)],
        *[F.max(F.when(slot == s, F.col("chars"))).alias(f"c{s}") for s in range(BLOCK)])
        .withColumn("span", F.floor(F.col("block") / SPAN)))
    cells = durable(cells)
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    later = (cells.where("len > " + str(SPAN * BLOCK)).groupBy("conv_id", "span").agg(*[F.bit_xor(f"own{i}").alias(f"own{i}") for i in (1, 2)])
             .select("conv_id", "span", *[F.bit_xor(f"own{i}").over(earlier).alias(f"far{i}") for i in (1, 2)]))
    return (cells.join(later, ["conv_id", "span"], "left")
            .select("conv_id", "block", "len",
                    *[F.coalesce(f"far{i}", zero).bitwiseXOR(F.coalesce(F.bit_xor(f"own{i}").over(within), zero)).alias(f"k{i}") for i in (1, 2)],
                    *[f"t{s}" for s in range(BLOCK)], *[f"c{s}" for s in range(BLOCK)]))


def rolled_up(blocks: DataFrame, sums: str) -> DataFrame:
    """One row per node: depth, (x1, x2) its name, (p1, p2) its parent's, and the aggregates
    ``sums`` over its members, all prefixes of all blocks in one grouping."""
    ids = [f"t{s}" for s in range(BLOCK)]
    rolled = blocks.sparkSession.sql(
        f"SELECT block, k1, k2, {', '.join(ids)}, grouping_id() AS gid, {sums} FROM {{blocks}} "
        f"GROUP BY block, k1, k2, ROLLUP ({', '.join(ids)})", blocks=blocks)
    # grouping_id has one bit for each column that is rolled away, the last columns first
    length = sum((F.when(F.col("gid") < 2 ** (BLOCK - s), 1).otherwise(0) for s in range(1, BLOCK)), F.when(F.col("gid") < 1, 1).otherwise(0))
    last = F.coalesce(*[F.when(F.col("in_block") == s + 1, F.col(f"t{s}")) for s in range(BLOCK)])
    rows = rolled.withColumn("in_block", length).where(
        last.isNotNull() | ((F.col("in_block") == 0) & (F.col("block") == 0)))
    first = F.col("block") * BLOCK

    def name(i: int, upto: Column) -> Column:
        out = F.col(f"k{i}")
        for s in range(BLOCK):
            out = out.bitwiseXOR(F.when(upto > s, _lane(i, first + s, F.col(f"t{s}"))).otherwise(0))
        return out

    inside = F.col("in_block")
    measured = [c for c in rolled.columns if c not in ("block", "k1", "k2", "gid", *ids)]
    return rows.select((first + inside).cast("long").alias("depth"), name(1, inside).alias("x1"), name(2, inside).alias("x2"),
                       name(1, inside - 1).alias("p1"), name(2, inside - 1).alias("p2"), F.col("in_block"), *measured)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, conv_id) -> (depth, x1, x2, ends_sha256): SHA-256 of the ascending ids of each
    node, comma-joined.  Rows are range-partitioned by node and id, and every task joins its runs to
    pieces of at most PIECE ids; the digest then reads a node's pieces one after the other, so no task
    holds a node's ids, and one that a third of all conversations end in sends some thousandth of its rows."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        out: list = []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if row[:3] != node or len(ids) == PIECE:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = row[:3], []
                ids.append(row[3])
            if out:
                yield _rows(out, ["depth", "x1", "x2", "first"], "ids")
                out = []
        if ids:
            yield _rows([(*node, ids[0], ",".join(map(str, ids)))], ["depth", "x1", "x2", "first"], "ids")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        out: list = []
        for batch in batches:
            for d, x1, x2, _, ids in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if (d, x1, x2) != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (d, x1, x2), hashlib.sha256(ids.encode())
                else:
                    digest.update(("," + ids).encode())
            if out:
                yield _rows(out, KEY, "ends_sha256")
                out = []
        if node:
            yield _rows([(*node, digest.hexdigest())], KEY, "ends_sha256")

    key = "depth long, x1 long, x2 long"
    parts = (ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
             .mapInArrow(pieces, f"{key}, first long, ids string"))
    return (parts.repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(digests, f"{key}, ends_sha256 string"))


def _rows(rows: list[tuple], numbers: list[str], text: str) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())],
                                      names=[*numbers, text])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; rows without conv_id take no part; repeated rows are turns of
    their own; an empty table has no node at all, not even the root; other columns are not read."""
    blocks = durable(blocks_of(rebuilt(turns_of(conversations))))
    chars = "CASE grouping_id() " + " ".join(f"WHEN {2 ** (BLOCK - s - 1) - 1} THEN max(c{s})" for s in range(BLOCK)) + " ELSE 0 END"
    nodes = rolled_up(blocks, f"min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS longest, {chars} AS chars")
    nodes = nodes.withColumn("weight", F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0))
    # a node's place in the run that its owner has, and what that run weighs above it
    runs = durable(ranked(nodes.drop("in_block"), ["conv_id"], ["depth"], value="weight"))
    owned = runs.groupBy("conv_id").agg(F.sum("weight").alias("weight"),
                                        F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    weighed = blocks.join(owned, "conv_id", "left").na.fill(0, ["weight", "leaf"])
    below = rolled_up(weighed, "sum(weight) AS weight, sum(leaf) AS n_leaves")
    nothing = {"conv_id": "long", "n_convs": "long", "rank": "long", "p1": "long", "p2": "long", "saved": "long",
               "n_leaves": "long", "n_children": "long", "ends_sha256": "string"}

    def facts(df: DataFrame, **known) -> DataFrame:
        return df.select(*KEY, *[(known[c] if c in known else F.lit(None)).cast(t).alias(c) for c, t in nothing.items()])

    tail = F.col("len") - F.col("block") * BLOCK
    ended = blocks.where(((tail > 0) & (tail <= BLOCK)) | (F.col("len") == 0))
    ends = ended.select(F.col("len").alias("depth"), "conv_id", *[
        _folded(i).alias(f"x{i}") for i in (1, 2)])
    each = (facts(runs, conv_id=F.col("conv_id"), n_convs=F.col("n_convs"), rank=F.col("_rank"), p1=F.col("p1"), p2=F.col("p2"), saved=-F.col("_before"))
            .unionByName(facts(below, saved=F.col("weight"), n_leaves=F.col("n_leaves")))
            .unionByName(facts(runs.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")),
                               n_children=F.lit(1)))
            .unionByName(facts(ends_digest(ends), ends_sha256=F.col("ends_sha256"))))
    whole = durable(each.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("conv_id", "n_convs", "rank", "p1", "p2", "ends_sha256")],
        *[F.sum(c).alias(c) for c in ("saved", "n_leaves", "n_children")]))
    # the first node of a run hangs on another owner's node, every other one on its own owner's
    hung = whole.where("rank = 0 and depth > 0").select(*KEY, "p1", "p2")
    owners = whole.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                                                  F.col("conv_id").alias("owner"))
    above = hung.join(owners, ["depth", "p1", "p2"]).select(*KEY, "owner")
    return whole.join(above, KEY, "left").select(
        "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("rank") > 0, F.col("conv_id")).otherwise(F.col("owner")).cast("long").alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def _folded(i: int) -> Column:
    """The name of the node that a block's last turn reaches."""
    out = F.col(f"k{i}")
    for s in range(BLOCK):
        out = out.bitwiseXOR(_lane(i, F.col("block") * BLOCK + s, F.col(f"t{s}")))
    return out
