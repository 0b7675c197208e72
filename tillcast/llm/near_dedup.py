"""Near-duplicate classes by MinHash with tensored banding (operator 3).

Tensored banding: instead of one fresh group of minhashes per table, two small collections
A_1..A_t and B_1..B_t of half keys (``depth`` minhashes each) are drawn, and table (i, j) is
keyed by the pair (A_i, B_j).  t*t tables of 2*depth minhashes cost 2*t*depth minhashes, about
the square root of what independent tables would.  A pair of similarity s meets in some table
exactly if it shares an A half and a B half: (1 - (1 - s^depth)^t)^2.  With depth 2 and t 10
that is 0.99993 at s = 0.8 and 1 - 1e-8 at 0.9.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import lists, map_rows
from tillcast.llm.graph import components
from tillcast.llm.shingles import WordHashes, ascii_words, mix, shingle_set
from tillcast.session import durable

TABLES_SIDE = 10
DEPTH = 2
FLUSH = 60_000


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def half_keys(flat: np.ndarray, starts: np.ndarray, side: int, depth: int) -> np.ndarray:
    """(rows, 2 * side) half keys of the non-empty sets that start at ``starts``."""
    seeds = _seeds(2 * side * depth)
    keys = np.zeros((len(starts), 2 * side), np.uint64)
    for k, seed in enumerate(seeds):
        low = np.minimum.reduceat(mix(flat ^ seed), starts)
        col = k // depth
        keys[:, col] = mix(keys[:, col] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(col + 1))
    return keys


def sketch(docs: DataFrame, size: int, side: int = TABLES_SIDE, depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, n_shingles, skey (digest of the shingle set, null without words) and
    the half keys a[side], b[side].  One pass over whole texts; texts never leave the task."""

    def make():
        words = WordHashes()

        def fn(cols):
            texts = cols["text"].cast(pa.binary()).to_pylist()
            counts = np.zeros(len(texts), np.int64)
            skeys: list = [None] * len(texts)
            keys = np.zeros((len(texts), 2 * side), np.uint64)
            held, at, total = [], [], 0

            def flush():
                if at:
                    starts = np.concatenate(([0], np.cumsum([len(s) for s in held])[:-1]))
                    keys[at] = half_keys(np.concatenate(held), starts, side, depth)
                    held.clear()
                    at.clear()

            for i, t in enumerate(texts):
                if t is None:
                    continue
                s = shingle_set(words.of(ascii_words(t)), size)
                if len(s):
                    counts[i] = len(s)
                    skeys[i] = hashlib.md5(s.tobytes()).digest()
                    held.append(s)
                    at.append(i)
                    total += len(s)
                    if total >= FLUSH:
                        flush()
                        total = 0
            flush()
            ends = np.arange(1, len(texts) + 1) * side
            return {"doc_id": cols["doc_id"], "n_shingles": counts, "skey": skeys,
                    "a": lists(keys[:, :side].reshape(-1).view(np.int64), ends),
                    "b": lists(keys[:, side:].reshape(-1).view(np.int64), ends)}

        return fn

    return map_rows(docs.select("doc_id", "text"), make,
                    "doc_id long, n_shingles long, skey binary, a array<long>, b array<long>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(rep, n, shingles) of whole texts: the sorted distinct shingles themselves."""

    def make():
        words = WordHashes()

        def fn(cols):
            texts = cols["text"].cast(pa.binary()).to_pylist()
            sets = [shingle_set(words.of(ascii_words(t or b"")), size) for t in texts]
            n = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            return {"rep": cols["doc_id"], "n": n, "shingles": lists(flat, np.cumsum(n))}

        return fn

    return map_rows(docs.select("doc_id", "text"), make, "rep long, n long, shingles array<long>").where("n > 0")


def candidate_tables(reps: DataFrame) -> DataFrame:
    """(key, rep, n, a, na): the rows of the tensored tables that two or more representatives
    share, each with the table's smallest member.

    A table key can only be shared if both its halves are, so the halves (2t rows a text) are
    counted first and only shared halves are paired up: most texts share none and never make
    their t*t keys."""
    halves = reps.select("rep", "n", F.posexplode("a").alias("i", "v"), F.lit("a").alias("side")).unionByName(
        reps.select("rep", "n", F.posexplode("b").alias("i", "v"), F.lit("b").alias("side")))
    halves = halves.select("rep", "n", "side", F.xxhash64("side", "i", "v").alias("h"))
    shared = halves.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    # at most t halves on either side for a representative: its own t*t tables, not a cross join
    own = (halves.join(shared, "h").groupBy("rep", "n")
           .agg(F.collect_set(F.when(F.col("side") == "a", F.col("h"))).alias("ha"),
                F.collect_set(F.when(F.col("side") == "b", F.col("h"))).alias("hb")))
    rows = durable(own.select("rep", "n", F.explode("ha").alias("ha"), "hb")
                   .select("rep", "n", "ha", F.explode("hb").alias("hb"))
                   .select("rep", "n", F.xxhash64("ha", "hb").alias("key")))
    first = (rows.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("f"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("key", F.col("f.rep").alias("a"), F.col("f.n").alias("na")))
    return durable(rows.join(first, "key"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, na, b, nb)`` whose full sets have 100 * |a and b| >= percent * |a or b|."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    fits = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).distinct()
    both = F.size(F.array_intersect("sa", "sb"))
    return durable(fits.join(left, ["a", "na"]).join(right, ["b", "nb"])
                   .where(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b").distinct())


class Classes:
    """The classes found so far: the class of a representative is its own id until it is linked."""

    def __init__(self):
        self.labels = None

    def of(self, rows: DataFrame, col: str, name: str) -> DataFrame:
        if self.labels is None:
            return rows.withColumn(name, F.col(col))
        known = self.labels.select(F.col("v").alias(col), F.col("label").alias("_known"))
        return rows.join(known, col, "left").withColumn(name, F.coalesce("_known", col)).drop("_known")

    def link(self, links: DataFrame) -> None:
        """Merge the classes that ``links(a, b)`` connect: only classes travel, not members."""
        met = self.of(self.of(links, "a", "ca"), "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        found = components(met)
        if self.labels is None:
            self.labels = found
        elif not found.isEmpty():
            step = found.select(F.col("v").alias("label"), F.col("label").alias("_to"))
            old = (self.labels.join(step, "label", "left").select("v", F.coalesce("_to", "label").alias("label")))
            self.labels = durable(old.unionByName(found.join(self.labels.select("v"), "v", "left_anti")))


def _open_rows(rows: DataFrame, classes: Classes) -> DataFrame:
    """``rows(key, rep, ..)`` with the class of each rep, of the keys that two classes share."""
    cols = durable(classes.of(rows, "rep", "class"))
    mixed = cols.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y")
    return durable(cols.join(mixed.select("key"), "key"))


def _prefix_rows(open_reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n, pos): the shingles of which two sets of similarity >= percent must share one.

    Order all shingles by how many open texts hold them, rarest first: sets of n and m
    shingles that agree in percent must meet within their first n - ceil(percent n / 100) + 1.
    Shingles of one text alone only use up places."""
    own = sets.join(open_reps, "rep", "left_semi").select("rep", "n", F.explode("shingles").alias("s"))
    df = own.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = (own.join(df, "s").groupBy("rep", "n")
              .agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o")))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100.0 - 1e-9) + 1
    return (ranked.select("rep", "n", F.posexplode(F.slice("o", F.lit(1), length.cast("int"))).alias("pos", "x"))
            .where("x.df > 1").select(F.col("x.s").alias("key"), "rep", "n", "pos"))


def _needed(n, m, percent: int):
    """Shingles that sets of n and m must have in common to be similar in ``percent``."""
    return F.ceil(percent * (n + m) / (100.0 + percent) - 1e-9)


def _prefix_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different classes that can still be links, by the first shingle they share.

    At their first common shingle, at places i and j, sets of n and m can have at most
    n - i and m - j in common; that must reach what the similarity asks for.  The smaller set's
    place therefore lies in its first n - needed(n, n) + 1, so only those rows are joined from
    its side: texts that merely share a passage drop out before they become pairs."""
    small = rows.where(F.col("n") - F.col("pos") >= _needed(F.col("n"), F.col("n"), percent)).select(
        "key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("class").alias("cb"))
    large = rows.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("class").alias("ca"))
    need = _needed(F.col("na"), F.col("nb"), percent)
    return (large.join(small, "key")
            .where((F.col("ca") != F.col("cb")) & ((F.col("na") > F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
                   & (F.col("na") - F.col("pa") >= need) & (F.col("nb") - F.col("pb") >= need))
            .select("a", "na", "b", "nb"))


def near_classes(reps: DataFrame, texts: DataFrame, size: int, percent: int) -> Classes:
    """Classes of ``reps(rep, n, a, b)`` that connect every link the tables retrieve: a pair is
    left unverified only if its ends are connected already, or if a shared-shingle bound proves
    that it cannot be a link.

    1. Star pairs: each member of a table against its smallest member (linear in the rows).
    2. Tables whose members are all of one class are done.  Members of the open ones go on to
       the prefix bound: rows (shingle, text) of the rarest shingles.
    3. Pairs of different classes that such a shingle still admits are compared.
    """
    classes = Classes()
    rows = candidate_tables(reps)
    members = texts.join(rows.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # repeated rows of a representative are one set, so that they multiply no pair
    members = members.withColumn("_h", F.xxhash64("text")).dropDuplicates(["doc_id", "_h"])
    sets = durable(shingle_sets(members, size))
    apart = rows.where("a <> rep")
    classes.link(_verified(apart.select("a", "na", F.col("rep").alias("b"), F.col("n").alias("nb")), sets, percent))
    # a table of two is settled by its star; of the others the members beside the centre remain
    rest = _open_rows(apart.select("key", "rep"), classes)
    if rest.isEmpty():
        return classes
    rest = _open_rows(_prefix_rows(rest.select("rep").distinct(), sets, percent), classes)
    classes.link(_verified(_prefix_pairs(rest, percent), sets, percent))
    return classes


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80,
                    side: int = TABLES_SIDE, depth: int = DEPTH) -> DataFrame:
    """Class of every row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Texts are linked if 100 * |shingles in both| >= percent * |shingles in either|;
    component_id is the smallest doc_id reachable.  Rows of equal shingle sets are one
    representative from the start, so copies are never paired up.

    Null or empty text (or white space only): 0 shingles, linked with nothing, kept.  Null
    doc_id: the row is returned with a null component_id and kept, and links nothing.
    Repeated rows share id and class.  Rows that carry the same doc_id with different texts
    are in one class, since they cannot be told apart.  No rows: no rows.  Other columns of
    ``docs`` are ignored, whatever their names."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    rows = durable(sketch(docs, size, side, depth))
    usable = rows.where("skey is not null and doc_id is not null")
    reps = durable(usable.groupBy("skey").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"),
                                              F.min("a").alias("a"), F.min("b").alias("b")))
    classes = near_classes(reps.select("rep", "n", "a", "b"), docs, size, percent)
    # doc_ids that carry several texts connect the copies of each
    ids = reps.select("skey", "rep")
    several = (usable.groupBy("doc_id").agg(F.min("skey").alias("x"), F.max("skey").alias("y")).where("x <> y")
               .select("doc_id"))
    extra = durable(usable.select("doc_id", "skey").join(several, "doc_id", "left_semi").join(ids, "skey")
                    .where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct())
    classes.link(extra)
    of_set = durable(classes.of(ids, "rep", "class").select("skey", "class"))
    return (rows.select("doc_id", "n_shingles", "skey").join(of_set, "skey", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
