"""What tasks and driver do to grow trees level by level: bins, blocks of binned rows, histograms of
the residuals, best splits, and the Spark model of the grown trees.

The rules are those of Spark's own regression trees: bin edges from 10,000 sampled rows (all, if there
are fewer), variance as impurity, categories ordered by their mean, a row at least in each child, the
first of equally good splits.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a task while there are fewer tasks than cores, and the most rows of a task (a byte or two each cell).
LEAST_ROWS, MOST_ROWS = 10_000, 200_000
#: Bytes that all tasks together send to the driver; more than these are summed in a shuffle.
DRIVER_BYTES = 16_000_000


# -- bins and blocks -------------------------------------------------------------------------------------

@dataclass
class Bins:
    """The thresholds of each numeric feature; of a nominal one the number of its categories."""
    edges: list

    def __post_init__(self):
        self.nominal = [np.isscalar(e) for e in self.edges]
        self.sizes = np.array([int(e) if n else len(e) + 1 for e, n in zip(self.edges, self.nominal)])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.most, self.cells = int(self.sizes.max()), int(self.starts[-1])

    @property
    def dtype(self):
        return np.uint8 if self.most <= 256 else np.uint16 if self.most <= 65_536 else np.uint32

    def coded(self, x: np.ndarray) -> np.ndarray:
        """The bins of rows ``x``, a feature after the other."""
        out = np.empty(x.shape[::-1], self.dtype)
        for f, (e, nominal) in enumerate(zip(self.edges, self.nominal)):
            out[f] = x[:, f] if nominal else np.searchsorted(e, x[:, f])
        return out


def value_edges(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """At most ``most - 1`` thresholds between ascending values, in equal strides of their counts."""
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < most:
        return middles.tolist()
    stride, out = counts.sum() / most, []
    target, seen = stride, counts[0]
    for i in range(1, len(values)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(float(middles[i - 1]))
            target += stride
    return out


def fit_bins(rows: DataFrame, most: int, seed: int) -> tuple[Bins, int]:
    """(bins, number of rows) of the ``features`` of ``rows``."""
    n = rows.count()
    if not n:
        raise ValueError("boosting needs training rows with a target")
    attrs = rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: len(a["vals"]) if "vals" in a else int(a["num_vals"]) for a in attrs.get("nominal", [])}
    nominal |= {a["idx"]: 2 for a in attrs.get("binary", [])}
    most = min(most, n)
    fraction = max(most * most, 10_000) / n
    some = rows.sample(fraction, seed) if fraction < 1 else rows
    counts = (some.select(F.posexplode(vector_to_array("features")).alias("feature", "x"))
                  .where(~F.col("feature").isin(list(nominal)) if nominal else F.lit(True)).groupBy("feature", "x").count())

    def edges(pdf):
        pdf = pdf.sort_values("x")
        return pd.DataFrame({"feature": [pdf["feature"].iloc[0]], "edges": [value_edges(pdf["x"].to_numpy(), pdf["count"].to_numpy(), most)]})

    found = {r["feature"]: np.array(r["edges"], float) for r in counts.groupBy("feature").applyInPandas(edges, "feature int, edges array<double>").collect()}
    width = rows.select(F.size(vector_to_array("features"))).first()[0]
    return Bins([nominal[f] if f in nominal else found.get(f, np.array([])) for f in range(width)]), n


def blocks(rows: DataFrame, held: DataFrame | None, label: str, bins: Bins, tasks: int) -> DataFrame:
    """Rows as (block, rows, bins, labels, held or not), thousands to a block."""
    def cut(df, flag):
        return df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.lit(flag).alias("held"))

    def pack(batches):
        first = TaskContext.get().partitionId() << 32
        for i, pdf in enumerate(b for b in batches if len(b)):
            yield pd.DataFrame({"block": [first + i], "n": [len(pdf)], "bins": [bins.coded(np.stack(pdf["x"].to_numpy())).tobytes()],
                                "y": [pdf["y"].to_numpy(float).tobytes()], "held": [pdf["held"].to_numpy(bool).tobytes()]})

    both = cut(rows, False) if held is None else cut(rows, False).unionByName(cut(held, True))
    return both.repartition(tasks).mapInPandas(pack, "block long, n int, bins binary, y binary, held binary")


def unpacked(row, dtype, points: int):
    """(block, bins of each feature, labels, held, score of each point)."""
    n = row["n"]
    return (row["block"], np.frombuffer(row["bins"], dtype).reshape(-1, n), np.frombuffer(row["y"]), np.frombuffer(row["held"], bool), np.zeros((points, n)))


# -- trees -----------------------------------------------------------------------------------------------

class Tree:
    """A tree in arrays; the children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, depth: int, most_bins: int):
        n = 2 ** (depth + 1) - 1
        self.levels = 0
        self.feature = np.full(n, -1, np.int32)                         # -1: a leaf
        self.left = np.zeros((max(1, n // 2), most_bins), bool)         # the bins that go left
        self.value, self.gain = np.zeros(n), np.zeros(n)
        self.slot = np.full(n, -1, np.int32)                            # of the nodes to be split next
        self.slot[0] = 0
        self.stats = None                                               # count, sum, sum of squares of each node

    def open(self) -> np.ndarray:
        return np.flatnonzero(self.slot >= 0)

    def leaf(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row has reached."""
        node = np.zeros(codes.shape[1], np.int32)
        for _ in range(self.levels):
            f = self.feature[node]
            inner = np.flatnonzero(f >= 0)
            at = node[inner]
            node[inner] = 2 * at + 2 - self.left[at, codes[f[inner], inner]]
        return node

    def split(self, level: int, last: bool, gain, feature, left, n, total, n_left, left_total) -> None:
        """Takes the best split of every open node; children with two rows or more are open next, unless this is the last level."""
        nodes = self.open()
        self.slot[:] = -1
        if level == 0:
            self.value[0] = total[0] / n[0] if n[0] else 0.0
        done = gain > 0
        at, kids = nodes[done], []
        self.feature[at], self.left[at], self.gain[at] = feature[done], left[done], gain[done] / n[done]
        for side, (m, s) in enumerate(((n_left, left_total), (n - n_left, total - left_total)), 1):
            self.value[2 * at + side] = s[done] / m[done]
            kids.append((2 * at + side)[m[done] >= 2])
        if len(at):
            self.levels = level + 1
        if not last:
            kids = np.sort(np.concatenate(kids))
            self.slot[kids] = np.arange(len(kids))

    def told(self, leaves: np.ndarray) -> None:
        """Node statistics from those of the leaves."""
        self.stats = leaves.copy()
        for i in range(len(self.left) - 1, -1, -1):
            if self.feature[i] >= 0:
                self.stats[i] = self.stats[2 * i + 1] + self.stats[2 * i + 2]
        self.slot = None

    def nodes(self, bins: Bins) -> list[tuple]:
        """The nodes as Spark stores them, numbered from the top, left before right."""
        out = []

        def add(i):
            at, (n, s, q) = len(out), self.stats[i].tolist()
            impurity = max(0.0, (q - s * s / n) / n) if n else 0.0
            head = (at, float(self.value[i]), impurity, [n, s, q], int(n))
            out.append(None)
            f = int(self.feature[i])
            if f < 0:
                out[at] = (*head, -1.0, -1, -1, (-1, [], -1))
                return at
            left = np.flatnonzero(self.left[i, :bins.sizes[f]])
            split = (f, left.astype(float).tolist(), int(bins.edges[f])) if bins.nominal[f] else (f, [float(bins.edges[f][left[-1]])], -1)
            out[at] = (*head, float(self.gain[i]), add(2 * i + 1), add(2 * i + 2), split)
            return at

        add(0)
        return out


NODE = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
        "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


def spark_model(spark, trees: list[Tree], weights: list[float], bins: Bins):
    """The trees as Spark's boosted model: stored as Spark stores one, then loaded."""
    from pyspark.ml.regression import GBTRegressionModel

    def about(kind, **more):
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": {"impurity": "variance"}, "defaultParamMap": {"impurity": "variance"}} | more)

    sc = spark.sparkContext
    path = f"{sc.getCheckpointDir()}/trees-{uuid.uuid4().hex}"
    rows = [(k, node) for k, tree in enumerate(trees) for node in tree.nodes(bins)]
    spark.createDataFrame(rows, NODE).write.parquet(f"{path}/data")
    spark.createDataFrame([(k, about("DecisionTreeRegressionModel", numFeatures=len(bins.edges)), w) for k, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(about("GBTRegressionModel", numFeatures=len(bins.edges), numTrees=len(trees)),)], "value string") \
         .coalesce(1).write.text(f"{path}/metadata")
    model = GBTRegressionModel.load(path)
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
    return model


# -- passes over the blocks ----------------------------------------------------------------------------------

def drawn(seed: int, block: int, n: int, rate: float) -> np.ndarray:
    """The rows of a block that a round takes: the same in every pass."""
    return np.ones(n, bool) if rate >= 1 else np.random.default_rng((seed, block)).random(n) < rate


def histograms(part, grown: dict, seed: int, bins: Bins, chunks: list):
    """Rows and residual sums of every (open node, bin) of each point's tree: (chunk of features, (task, {point: (counts, sums)}))."""
    sums = {}
    for block, codes, y, held, score in part:
        for g, (tree, rate) in grown.items():
            slot = tree.slot[tree.leaf(codes)]
            rows = np.flatnonzero(~held & (slot >= 0) & drawn(seed, block, len(y), rate))
            slot, residual, taken = slot[rows].astype(np.int64), (y - score[g])[rows], codes[:, rows]
            slots = len(tree.open())
            if g not in sums:
                sums[g] = np.zeros((slots, bins.cells), np.int64), np.zeros((slots, bins.cells))
            counts, totals = sums[g]
            for f, (size, a) in enumerate(zip(bins.sizes, bins.starts)):
                at = slot * size + taken[f]
                counts[:, a:a + size] += np.bincount(at, minlength=slots * size).reshape(slots, size)
                totals[:, a:a + size] += np.bincount(at, residual, slots * size).reshape(slots, size)
    task = TaskContext.get().partitionId()
    for i, (a, b) in enumerate(chunks):
        cut = slice(bins.starts[a], bins.starts[b])
        if sums:
            yield i, (task, {g: (n[:, cut].astype(np.int32), s[:, cut]) for g, (n, s) in sums.items()})


def best_splits(hists: dict, chunk: tuple, bins: Bins, allowed: dict) -> dict:
    """{point: (gain, feature, left bins, rows, sum, left rows, left sum) of each open node} over the features of a chunk."""
    out, first, alike = {}, bins.starts[chunk[0]], {}
    for f in range(*chunk):
        if bins.sizes[f] > 1:
            alike.setdefault((int(bins.sizes[f]), bins.nominal[f]), []).append(f)
    for g, (counts, sums) in hists.items():
        slots, row = len(counts), np.arange(len(counts))
        top = slice(0, bins.sizes[chunk[0]])
        n, total = counts[:, top].sum(1).astype(float), sums[:, top].sum(1)
        share = total / np.maximum(n, 1)
        # of each feature: the best gain, the bin (or rank of the category) of its split, rows and sum on its left
        gains, ends, n_left, left_total = (np.zeros((slots, chunk[1] - chunk[0])) for _ in range(4))
        orders = {}
        for (size, nominal), some in alike.items():
            cells = (bins.starts[some] - first)[:, None] + np.arange(size)
            c, s = counts[:, cells].astype(float), sums[:, cells]
            if nominal:
                order = np.argsort(np.where(c > 0, s / np.maximum(c, 1), np.inf), axis=2, kind="stable")
                c, s = np.take_along_axis(c, order, 2), np.take_along_axis(s, order, 2)
                orders |= {f: order[:, i] for i, f in enumerate(some)}
            nl, sl = c.cumsum(2)[:, :, :-1], s.cumsum(2)[:, :, :-1]
            both = nl * (n[:, None, None] - nl)
            gain = np.where(both > 0, (sl - share[:, None, None] * nl) ** 2 * n[:, None, None] / np.maximum(both, 1), -1.0)
            at = gain.argmax(2)[:, :, None]
            here = np.array(some) - chunk[0]
            for into, value in ((gains, gain), (n_left, nl), (left_total, sl)):
                into[:, here] = np.take_along_axis(value, at, 2)[:, :, 0]
            ends[:, here] = at[:, :, 0]
        if allowed.get(g) is not None:
            gains = np.where(allowed[g][:, chunk[0]:chunk[1]], gains, 0.0)
        best = gains.argmax(1)
        feature, end = best + chunk[0], ends[row, best]
        left = np.arange(bins.most) <= end[:, None]
        for i in np.flatnonzero(np.isin(feature, list(orders))):
            order = orders[feature[i]][i]
            left[i] = False
            left[i, order[:int(end[i]) + 1]] = True
        out[g] = gains[row, best], feature.astype(np.int32), left, n, total, n_left[row, best], left_total[row, best]
    return out


def better_of(some: list[dict]) -> dict:
    """The best splits over all chunks, the first of equally good ones."""
    out = {}
    for found in some:
        for g, new in found.items():
            if g in out:
                more = new[0] > out[g][0]
                new = tuple(np.where(more[:, None] if x.ndim > 1 else more, y, x) for x, y in zip(out[g], new))
            out[g] = new
    return out


def advanced(part, trees: dict):
    """Blocks whose scores have the trees' values added."""
    for block, codes, y, held, score in part:
        score = score.copy()
        for g, (tree, weight) in trees.items():
            score[g] += weight * tree.value[tree.leaf(codes)]
        yield block, codes, y, held, score


def replayed(part, stretch: dict, seed: int):
    """Of the rounds of a stretch, from the scores before it: statistics of the leaves, squared errors and number of held rows."""
    sums = {}
    for block, codes, y, held, score in part:
        for g, (first, trees, weights, rate) in stretch.items():
            now, leaves, errors = score[g].copy(), [], []
            for k, (tree, weight) in enumerate(zip(trees, weights), first):
                leaf, use = tree.leaf(codes), ~held & drawn(seed + k, block, len(y), rate)
                r, size = (y - now)[use], len(tree.feature)
                leaves.append(np.stack([np.bincount(leaf[use], w, size) for w in (np.ones(len(r)), r, r * r)], 1))
                now = now + weight * tree.value[leaf]
                errors.append([((y - now)[held] ** 2).sum(), held.sum()])
            new = np.stack(leaves), np.array(errors, float)
            sums[g] = tuple(a + b for a, b in zip(sums[g], new)) if g in sums else new
    task = TaskContext.get().partitionId()
    for g, v in sums.items():
        yield g, (task, {g: v})


def merged(pairs):
    """(key, arrays summed over the tasks in their order: the same sums in every run)."""
    found = {}
    for key, value in pairs:
        found.setdefault(key, []).append(value)
    for key in sorted(found):
        out = {}
        for _, arrays in sorted(found.pop(key), key=lambda v: v[0]):
            for g, v in arrays.items():
                out[g] = tuple(a + b for a, b in zip(out[g], v)) if g in out else tuple(a.astype(np.int64) if a.dtype == np.int32 else a for a in v)
        yield key, out


def gathered(pairs, finish, size: int, keys: int) -> list:
    """[finish(key, summed arrays)] by key: summed by the driver if all tasks send it little, else in a shuffle."""
    if size <= DRIVER_BYTES:
        return [finish(k, v) for k, v in merged(pairs.collect())]
    spread = pairs.partitionBy(max(1, min(keys, -(-size // DRIVER_BYTES), pairs.context.defaultParallelism * 4)), lambda k: k)
    return [v for _, v in sorted(spread.mapPartitions(lambda part: ((k, finish(k, v)) for k, v in merged(part))).collect(), key=lambda kv: kv[0])]
