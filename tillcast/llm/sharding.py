"""Sharding by balanced label propagation (operator 5).

Vertices are the groups of equal texts (a group moves as one), links are the lines that
different texts share.  Every round each group looks at the shards of the groups it shares
lines with and wants the shard where most of them are; moves against each other are swapped,
and what is left is admitted by gain, up to the free capacity of the wanted shard.  Groups
without links then fill the shards up, and a cut of the resulting order at exact quantiles
makes the row counts at most one apart (law ``rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.ranks import ranked
from tillcast.session import durable

SHARDS = 16
GAIN_STEPS = 8
#: Rounds end when two of them (a round moves one half of the groups) admit less than this share
#: of the linked rows, or no less than the two before: groups then only change places.
LEAST_MOVED = 0.02
#: A group of more than one part in this many of all rows is many keys of a join.
LARGE = 2_000


def shared_lines(docs: DataFrame) -> DataFrame:
    """(cell, hub): the lines that two or more different texts hold, blank ones aside.  Equal texts are
    one cell, so copies add no rows."""
    lines = (docs.where("text is not null").select(_cell().alias("cell"), F.explode(F.split("text", "\n")).alias("l"))
             .where(F.trim("l") != "").select("cell", F.xxhash64("l").alias("hub")).distinct())
    lines = durable(lines)
    held = lines.groupBy("hub").count().where("count > 1").select("hub")
    return durable(lines.join(held, "hub"))


def _cell() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _moves(state: DataFrame, edges: DataFrame, shards: int, step: int) -> DataFrame:
    """(cell, chunk, w, label, target, gain) of the groups that another shard draws more than their own.

    A line pulls with the share of its groups that each shard holds, so a line that very many
    texts share pulls weakly and evenly.  The histogram of a line is combined map-side and is
    one row of ``shards`` numbers.  A hash picks the half of the groups that may move in a round,
    so that two linked groups do not swap places for ever."""
    placed = edges.join(state, "cell")
    count = [F.sum(F.when(F.col("label") == k, 1).otherwise(0)) for k in range(shards)]
    hist = placed.groupBy("hub").agg(F.array(*count).alias("h"), F.count(F.lit(1)).alias("n"))
    pull = [F.sum(F.col("h")[k] / F.col("n")) for k in range(shards)]
    turn = F.pmod(F.xxhash64("cell", "chunk", F.lit(~step)), F.lit(2)) == 0
    wants = (placed.where(turn).join(hist, "hub").groupBy("cell", "chunk", "w", "label")
             .agg(F.array(*pull).alias("p"), F.sum(1 / F.col("n")).alias("self"), F.count(F.lit(1)).alias("degree")))
    # what a group itself adds to its own shard does not hold it there
    wants = wants.withColumn("p", F.transform("p", lambda x, k: x - F.when(k == F.col("label"), F.col("self")).otherwise(0)))
    own, best = F.get("p", F.col("label")), F.array_max("p")
    out = wants.select("cell", "chunk", "w", "label", (F.array_position("p", best) - 1).cast("int").alias("target"),
                       ((best - own) / F.col("degree")).alias("gain"))
    return out.where((F.col("gain") > 1e-9) & (F.col("target") != F.col("label")))


def _cycle(rest: dict) -> list:
    """A shortest cycle of shards along which volume still wants to move, or none."""
    best: list = []
    for a in sorted({a for a, _ in rest}):
        paths = {a: [a]}
        queue = [a]
        for x in queue:
            if best and len(paths[x]) >= len(best):
                break
            if (x, a) in rest:
                best = paths[x]
                break
            for y in sorted(t for f, t in rest if f == x and t not in paths):
                paths[y] = [*paths[x], y]
                queue.append(y)
    return best


def _flows(volumes: dict, load: dict, quota: float) -> dict:
    """How much of each ``volumes[from, to, gain step]`` moves.  Volumes in a cycle (two shards
    that want each other's groups, or more) change no load and go first; the rest goes by gain
    into free capacity, which every move opens where it comes from."""
    rest = {}
    for (a, b, _), v in volumes.items():
        rest[a, b] = rest.get((a, b), 0.0) + v
    flow = dict.fromkeys(rest, 0.0)
    while ring := _cycle(rest):
        hops = list(zip(ring, ring[1:] + ring[:1]))
        least = min(rest[h] for h in hops)
        for h in hops:
            flow[h] += least
            rest[h] -= least
            if rest[h] <= 1e-9:
                del rest[h]
    out = {}
    for a, b, level in sorted(volumes, key=lambda k: -k[2]):
        out[a, b, level] = min(volumes[a, b, level], flow[a, b])
        flow[a, b] -= out[a, b, level]
    load, moved = dict(load), True
    while moved:
        moved = False
        for k in sorted(volumes, key=lambda k: (-k[2], -volumes[k], k)):
            take = min(volumes[k] - out[k], quota - load[k[1]])
            if take > 1e-6 * quota:
                out[k] += take
                load[k[1]] += take
                load[k[0]] -= take
                moved = True
    return out


def _admit(state: DataFrame, moves: DataFrame, quota: float, shards: int, step: int) -> tuple[DataFrame, float]:
    """The state after the admitted moves, and their volume.  Volumes by (from, to, gain step), shards *
    shards * GAIN_STEPS numbers at most, decide what share of each is admitted; a hash picks the groups."""
    m = durable(moves.withColumn("level", F.least(F.floor(F.col("gain") * GAIN_STEPS), F.lit(GAIN_STEPS - 1)).cast("int")))
    at = ["label", "target", "level"]
    sums = (m.select(*at, "w").unionByName(state.select("label", F.lit(-1).alias("target"), F.lit(-1).alias("level"), "w"))
            .groupBy(*at).agg(F.sum("w").alias("w")).collect())
    load = dict.fromkeys(range(shards), 0.0) | {r["label"]: float(r["w"]) for r in sums if r["target"] < 0}
    volumes = {(r["label"], r["target"], r["level"]): float(r["w"]) for r in sums if r["target"] >= 0}
    if not volumes:
        return state, 0.0
    flows = _flows(volumes, load, quota)
    share = state.sparkSession.createDataFrame([(*k, take / volumes[k]) for k, take in sorted(flows.items())],
                                               "label int, target int, level int, share double")
    luck = F.pmod(F.xxhash64("cell", "chunk", F.lit(step)), F.lit(1 << 20)) / float(1 << 20)
    go = m.join(F.broadcast(share), at).where(luck < F.col("share")).select("cell", "chunk", "target")
    after = state.join(go, ["cell", "chunk"], "left").select("cell", "chunk", "w", F.coalesce("target", "label").alias("label"))
    return durable(after), sum(flows.values())


def propagate(linked: DataFrame, edges: DataFrame, quota: float, shards: int) -> DataFrame:
    """Labels of the linked groups (cell, chunk, w): an even start in hash order, then rounds until next
    to nothing moves."""
    start = ranked(linked.withColumn("_h", F.xxhash64("cell", "chunk")), [], ["_h", "cell", "chunk"], "w")
    whole = float(linked.agg(F.sum("w")).first()[0] or 1)
    middle = (F.col("_before") + F.col("w") / 2) * shards / whole
    state = durable(start.select("cell", "chunk", "w", F.least(F.floor(middle), F.lit(shards - 1)).cast("int").alias("label")))
    moved, step = [], 0
    while True:
        state, volume = _admit(state, _moves(state, edges, shards, step), quota, shards, step)
        moved.append(volume)
        step += 1
        if step % 2 == 0 and (sum(moved[-2:]) < LEAST_MOVED * whole or step > 2 and sum(moved[-2:]) >= sum(moved[-4:-2])):
            return state


def shard_documents(docs: DataFrame, shards: int = SHARDS, slot_order: list[str] | None = None) -> DataFrame:
    """Shard of every row: doc_id, size (UTF-8 bytes of the text + 1), text_crc32, law, shard,
    slot, grown_shard, linked (its text shares a line with another text).

    Law ``rows``: the counts of any two shards differ by at most one.  Equal texts share a
    shard as far as that allows: a group larger than half a shard is split into pieces of at
    most that, and at most one group is cut at each of the shards - 1 borders, single rows
    being put there whenever a shard has any.  ``slot_order``: columns that order the slots.

    Null text: size 1, crc32 of no bytes, one group with the empty text.  Null doc_id: a row
    like any other.  Repeated rows each get a slot.  Fewer rows than shards: shards stay empty.
    No rows: no rows.  Other columns are ignored."""
    text = F.coalesce("text", F.lit(""))
    order = slot_order or []
    base = durable(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), _cell().alias("cell"), F.monotonically_increasing_id().alias("row"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]))
    rows = base.count()
    if not rows:
        return base.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                           F.lit(False).alias("linked"))
    quota = rows / shards
    edges = shared_lines(docs)
    cells = base.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n") * 2 / F.lit(quota))).cast("int")
    groups = durable(cells.join(edges.select("cell").distinct().withColumn("linked", F.lit(True)), "cell", "left")
                     .withColumn("pieces", pieces).withColumn("linked", F.coalesce("linked", F.lit(False)))
                     .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
                     .withColumn("w", F.col("n") / F.col("pieces")))
    state = propagate(groups.where("linked").select("cell", "chunk", "w"), edges, quota, shards)
    load = dict.fromkeys(range(shards), 0.0)
    load |= {r[0]: float(r[1]) for r in state.groupBy("label").agg(F.sum("w")).collect()}
    # groups without links fill what is free, shard after shard
    free = ranked(groups.where("not linked").select("cell", "chunk", "w", F.xxhash64("cell", "chunk").alias("_h")),
                  [], ["_h", "cell", "chunk"], "w")
    room = [max(0.0, quota - load[k]) for k in range(shards)]
    scale = (rows - sum(load.values())) / (sum(room) or 1.0)
    label, upto = F.lit(shards - 1), sum(room) * scale
    for k in reversed(range(shards)):
        label = F.when(F.col("_before") + F.col("w") / 2 < upto, F.lit(k)).otherwise(label)
        upto -= room[k] * scale
    labels = state.select("cell", "chunk", "label").unionByName(free.select("cell", "chunk", label.alias("label")))
    # every row finds its group's label by (cell, chunk, salt); only large groups, LARGE at most, have
    # more than one chunk or salt, so what these are is broadcast
    most = F.lit(float(rows)) / LARGE
    large = (groups.where(F.col("w") * F.col("pieces") > most).groupBy("cell")
             .agg(F.max("pieces").alias("pieces"), F.ceil(F.max("w") / most).cast("int").alias("salts")))
    known = F.broadcast(large)
    spread = (groups.join(labels, ["cell", "chunk"]).join(known.select("cell", "salts"), "cell", "left")
              .select("cell", "chunk", "linked", "w", "label", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")))
    luck = F.xxhash64(F.coalesce("doc_id", F.col("row")))
    placed = (base.join(known, "cell", "left").fillna(1, ["pieces", "salts"])
              .withColumn("chunk", F.pmod(luck, F.col("pieces")).cast("int"))
              .withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")).drop("pieces", "salts")
              .join(spread, ["cell", "chunk", "salt"])
              .withColumn("end", F.when(F.col("w") > 1, 1).otherwise(F.pmod("cell", F.lit(2)) * 2)))
    # single rows lie at both ends of a label, so that the borders fall between them
    cut = ranked(placed, [], ["label", "end", "cell", "chunk", "doc_id"])
    shard = F.floor(F.col("_rank") * shards / F.lit(rows)).cast("int")
    first = F.ceil(shard * F.lit(rows) / F.lit(shards)).cast("long")
    out = cut.withColumn("shard", shard).withColumn("slot", (F.col("_rank") - first).cast("long"))
    if order:
        names = [f"_o{i}" for i in range(len(order))]
        out = ranked(out.drop("_rank", "slot"), ["shard"], names).withColumn("slot", F.col("_rank").cast("long"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "linked")


def shards_touched(edges: DataFrame, placed: DataFrame) -> DataFrame:
    """Cut of a placement (cell, shard): per shared line, how many shards beyond one hold it."""
    return (edges.join(placed.select("cell", "shard").distinct(), "cell").groupBy("hub")
            .agg((F.countDistinct("shard") - 1).alias("cut")).agg(F.sum("cut").alias("cut")))
