"""Approximate nearest neighbours by balanced posting lists (operator 9).

Vectors (scaled to length 1) are grouped around centroids found by size-penalised k-means on a
bounded sample; their number grows with the square root of the rows, so lists stay short.  A
vector near a border goes to the lists of several centroids (all within a distance ratio of its
nearest, unless a chosen centroid is closer to that centroid than the vector is).  A query
searches the centroids through an in-memory neighbour graph and reads the lists whose centroid
lies within a distance ratio of its nearest; candidates are scored exactly.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.arrow_rows import lists, map_rows
from tillcast.session import durable

SAMPLE = 20_000
SAMPLE_QUERIES = 400
MOST_CENTROIDS = 4_096
REPLICAS = 4
BORDER_RATIO = 1.25
DEGREE = 16
AIM = 0.965
SLICE_ROWS = 4_096
BUCKET_ROWS = 65_536


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray     # (m, dim), length 1
    graph: np.ndarray         # (m, degree) neighbouring centroids
    entries: np.ndarray       # where a search begins
    ratio: float              # lists within this distance ratio of the nearest are read

    def lists_of(self, x: np.ndarray) -> list[np.ndarray]:
        """Posting lists of each row of ``x``: its nearest centroid and those of near borders."""
        d = _distances(x, self.centroids)
        near = np.argsort(d, axis=1, kind="stable")[:, :4 * REPLICAS]
        out = []
        for row, order in zip(d, near):
            chosen = [order[0]]
            for c in order[1:]:
                if row[c] > BORDER_RATIO * row[order[0]] or len(chosen) == REPLICAS:
                    break
                between = np.sqrt(np.maximum(0, 2 - 2 * self.centroids[chosen] @ self.centroids[c]))
                if (between > 0.8 * row[c]).all():
                    chosen.append(c)
            out.append(np.array(chosen))
        return out

    def search(self, q: np.ndarray) -> np.ndarray:
        """The lists to read for one query: best-first over the centroid graph, which goes on
        while it finds centroids within the ratio of the nearest seen."""
        dist = {int(c): float(d) for c, d in zip(self.entries, _distances(q[None], self.centroids[self.entries])[0])}
        heap = [(d, c) for c, d in dist.items()]
        heapq.heapify(heap)
        best, beyond = min(dist.values()), 0
        while heap and beyond < 4 * DEGREE:
            d, c = heapq.heappop(heap)
            beyond = beyond + 1 if d > self.ratio * best else 0
            new = np.array([n for n in self.graph[c] if int(n) not in dist], np.int64)
            if len(new):
                for n, e in zip(new, _distances(q[None], self.centroids[new])[0]):
                    dist[int(n)] = float(e)
                    heapq.heappush(heap, (float(e), int(n)))
                    best = min(best, float(e))
        return np.array(sorted(c for c, d in dist.items() if d <= self.ratio * best), np.int64)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * x @ c.T))


def fit_index(sample: np.ndarray, rows: int, seed: int = 7) -> Index:
    """``sample``: unit vectors; ``rows``: how many vectors will be indexed.  The pruning ratio
    is the smallest that keeps AIM of the true neighbours inside the sample."""
    rng = np.random.default_rng(seed)
    m = max(1, min(MOST_CENTROIDS, len(sample) // 4, math.ceil(2 * math.sqrt(rows))))
    c = sample[rng.choice(len(sample), m, replace=False)]
    size = np.full(m, len(sample) / m)
    for _ in range(10):
        # a list above the mean size is made to look farther away: the lists even out
        cost = _distances(sample, c) + 0.05 * (size * m / len(sample) - 1)
        at = cost.argmin(1)
        size = np.bincount(at, minlength=m).astype(float)
        total = np.zeros_like(c)
        np.add.at(total, at, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        lost = norm[:, 0] < 1e-9
        c = np.where(lost[:, None], sample[rng.choice(len(sample), m)], total / np.maximum(norm, 1e-9))
    between = _distances(c, c)
    graph = np.argsort(between, axis=1, kind="stable")[:, 1:DEGREE + 1]
    # a few far links keep the graph in one piece
    far = rng.integers(0, m, (m, min(4, m)))
    index = Index(c, np.hstack([graph, far]), rng.choice(m, min(m, 32), replace=False), math.inf)
    return Index(index.centroids, index.graph, index.entries, _ratio(index, sample, rng))


def _ratio(index: Index, sample: np.ndarray, rng) -> float:
    at = rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    sims = sample[at] @ sample.T
    sims[np.arange(len(at)), at] = -9
    k = min(5, len(sample) - 1)
    if k < 1:
        return 2.0
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    d = _distances(sample[at], index.centroids)
    places = dict(zip(np.unique(near), index.lists_of(sample[np.unique(near)])))
    need = [d[i, places[v]].min() / max(d[i].min(), 1e-9) for i in range(len(at)) for v in near[i]]
    return float(max(1.05, np.quantile(need, AIM)))


def usable_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v double array, h) of the vectors that take part: those of the most frequent
    length, without null or non-finite components, not zero, with an id."""
    v = F.col("embedding").cast("array<double>")
    clean = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
             .where("vec_id is not null and v is not null and size(v) > 0")
             .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
             .where(F.exists("v", lambda x: x != 0)))
    length = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not length:
        return clean.withColumn("h", F.xxhash64("v")).limit(0)
    # -0.0 and 0.0 are one value; the hash names the distinct vector
    return (clean.where(F.size("v") == length[0]["n"])
            .withColumn("h", F.xxhash64(F.transform("v", lambda x: x + F.lit(0.0)))).distinct())


def nearest(rows: DataFrame, is_query, k: int = 5) -> DataFrame:
    """The ``k`` nearest of each query row among all other rows: query_id, rank, vec_id, score
    (cosine in double precision on the original vectors); ties to the smaller vec_id.

    ``is_query``: a condition on vec_id.  Rows of equal vectors are one entry of the index that
    carries their k + 1 smallest ids, which is all that a top-k with ties by id can need, so a
    vector that a third of all rows share is scored once.  Every distinct vector is indexed;
    only the centroids are fitted on a sample (SAMPLE rows at most).  Lists are
    dealt out in buckets and slices of bounded size, so that no task holds a long list.

    Vectors that are null, zero, of another length than most, or hold null or non-finite
    components take no part, nor do rows without vec_id.  Repeated rows count once; one vec_id
    with several vectors is several candidates, of which the nearest counts.  Fewer than k
    candidates: all of them.  No rows: no rows.  Other columns are ignored."""
    spark = rows.sparkSession
    vectors = durable(usable_vectors(rows))
    by_id = Window.partitionBy("h").orderBy("vec_id")
    # the limit of k + 1 ids is applied in every task before the shuffle
    ids = (vectors.select("h", "vec_id").withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
           .groupBy("h").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    distinct = durable(vectors.groupBy("h").agg(F.min("v").alias("v")).join(ids, "h"))
    n = distinct.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    first = distinct.select("h", "v").orderBy(F.xxhash64("h", F.lit(1)), "h").limit(SAMPLE).collect()
    sample = np.array([r["v"] for r in first])
    index = fit_index(sample / np.linalg.norm(sample, axis=1, keepdims=True), n)
    shared = spark.sparkContext.broadcast(index)               # MOST_CENTROIDS vectors at most
    queries = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "h")
    asked_vectors = durable(distinct.join(queries.select("h").distinct(), "h", "left_semi").select("h", "v"))
    asked = asked_vectors.count()
    # lists are dealt out in buckets, long lists and many queries in slices: a task holds about
    # BUCKET_ROWS entries and SLICE_ROWS queries at most, and answers a query once per bucket
    entries = 2 * n
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(entries / BUCKET_ROWS))
    buckets = min(buckets, len(index.centroids))
    slices = max(1, math.ceil(entries / len(index.centroids) / SLICE_ROWS))
    ask_slices = max(1, math.ceil(asked / SLICE_ROWS))

    def assigner(search: bool):
        def make():
            ix = shared.value

            def fn(cols):
                x = np.array(cols["v"].to_pylist(), dtype=float).reshape(len(cols["v"]), -1)
                u = x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x
                got = [ix.search(q) for q in u] if search else ix.lists_of(u) if len(x) else []
                flat = np.concatenate([*got, np.empty(0, np.int64)]).astype(np.int64)
                ends = np.cumsum([len(g) for g in got])
                return {"id": cols["id"], "v": cols["v"], "lists": lists(flat, ends)}

            return fn
        return make

    shape = "id long, v array<double>, lists array<long>"
    bucket = F.pmod("list", F.lit(buckets)).cast("int").alias("bucket")
    posts = (map_rows(distinct.select(F.col("h").alias("id"), "v"), assigner(False), shape)
             .select(F.explode("lists").alias("list"), "id", "v")
             .select("list", bucket, "id", "v", F.pmod("id", F.lit(slices)).cast("int").alias("slice"))
             .withColumn("ask_slice", F.explode(F.sequence(F.lit(0), F.lit(ask_slices - 1)))))
    asks = (map_rows(asked_vectors.select(F.col("h").alias("id"), "v"), assigner(True), shape)
            .select(F.explode("lists").alias("list"), "id", "v").select("list", bucket, "id", "v")
            .groupBy("id", "v", "bucket").agg(F.collect_list("list").alias("lists"))
            .withColumn("ask_slice", F.pmod(F.xxhash64("id"), F.lit(ask_slices)).cast("int"))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))

    def score(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_h": np.empty(0, np.int64), "h": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(asked) or not len(held):
            return empty
        q, x = np.stack(asked["v"].to_numpy()), np.stack(held["v"].to_numpy())
        q, x = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (q, x))
        hs, ids, of_list = held["id"].to_numpy(), asked["id"].to_numpy(), held["list"].to_numpy()
        asks_for: dict = {}
        for i, wanted in enumerate(asked["lists"]):
            for w in wanted:
                asks_for.setdefault(int(w), []).append(i)
        who, what, near = [], [], []
        for w, at in asks_for.items():
            entries = np.flatnonzero(of_list == w)
            if len(entries):
                s = q[at] @ x[entries].T
                take = min(len(entries), k + 1)
                floor = -np.partition(-s, take - 1, axis=1)[:, take - 1:take] - 1e-9     # ties included
                i, j = np.nonzero(s >= floor)
                who.append(np.array(at)[i])
                what.append(hs[entries[j]])
                near.append(s[i, j])
        if not who:
            return empty
        out = pd.DataFrame({"q": np.concatenate(who), "h": np.concatenate(what), "score": np.concatenate(near)})
        out = out.groupby(["q", "h"], as_index=False)["score"].max()       # an entry of several lists
        out = out[out.groupby("q")["score"].rank(method="min", ascending=False) <= k + 1]
        return pd.DataFrame({"query_h": ids[out["q"]], "h": out["h"].to_numpy(), "score": out["score"].to_numpy()})

    place = ["bucket", "slice", "ask_slice"]
    found = (asks.groupBy(*place).cogroup(posts.groupBy(*place))
             .applyInPandas(score, "query_h long, h long, score double"))
    best = Window.partitionBy("query_h").orderBy(F.desc(F.round("score", 9)))
    few = (found.groupBy("query_h", "h").agg(F.max("score").alias("score"))
           .withColumn("r", F.rank().over(best)).where(F.col("r") <= k + 1).select("query_h", "h"))
    exact = (few.join(distinct.withColumnRenamed("v", "cv"), "h")
             .join(asked_vectors.select(F.col("h").alias("query_h"), "v"), "query_h")
             .select("query_h", cosine("v", "cv").alias("score"), F.explode("ids").alias("vec_id"))
             .groupBy("query_h", "vec_id").agg(F.max("score").alias("score")))
    # k + 1 are kept for each query vector, since a query's own id is dropped from them
    order = Window.partitionBy("query_h").orderBy(F.desc("score"), "vec_id")
    top = durable(exact.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.join(top.withColumnRenamed("query_h", "h"), "h").where("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def cosine(a: str, b: str):
    """Cosine of two double arrays, summed in order of the components."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
