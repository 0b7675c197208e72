"""Model fitting on the feature table.

Linear model (L3-L6): one-hot (first level dropped, unseen level all zeros),
median imputation and population standardisation fitted on train, then
ridge regression with a contiguous 5-fold search over alphas.  The search
needs only per-fold sufficient statistics ([1 x]'[1 x], [1 x]'y, y'y): each
task folds its rows into a (p+1)^2 matrix per fold with numpy, Spark sums
them by (fold, cell), and every (alpha, fold) fit is a p x p solve on the
driver.  Data is read once, whatever the number of alphas and folds; what
reaches the driver is bounded by folds x features^2.  The fitted model is
a linear Column expression, so scoring stays in whole-stage codegen.

Boosted trees (L7-L9): three parameter families standing in for the three
boosting libraries.  All fits of a query grow together, one Spark job a level
(``BoostedGrid``, ``tree_growth``); the rows' bins and scores are kept and
checkpointed, so a fit can go on until patience on the validation rows ends it.
The result is Spark ML's own boosted model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.quantiles import exact_percentiles, global_positions
from tillcast.operators import tree_growth as tg
from tillcast.schemas import KEYS, MODEL_INPUTS
from tillcast.session import durable

CATEGORICAL = ["store_type", "dept_id"]
TARGET = "weekly_sales"
# The ridge penalty grid of the reference
RIDGE_ALPHAS = (0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0)


# -- L2 / L3: inputs and one-hot --------------------------------------------------------------

def numeric_inputs(df: DataFrame) -> list[str]:
    return [c for c in MODEL_INPUTS if c not in CATEGORICAL and c in df.columns]


def category_levels(train: DataFrame, col: str, cap: int = 10_000) -> list:
    """Sorted levels seen in train (a dimension: bounded, and checked)."""
    rows = train.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(cap + 1).collect()
    if len(rows) > cap:
        raise ValueError(f"{col} has more than {cap} levels")
    return [r[0] for r in rows]


def one_hot_columns(levels: dict) -> dict:
    """L3: indicator per level except the first; an unseen level gives all zeros."""
    out = {}
    for col, lv in levels.items():
        for level in lv[1:]:
            out[f"{col}_{level}"] = (F.col(col) == F.lit(level)).cast("double")
    return out


# -- L4 / L5: imputation and scaling fitted on train --------------------------------------------

def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                                for c in cols]))
    return df.select(pairs.alias("_p")).select("_p.feature", "_p.x")


def fit_medians(train: DataFrame, cols: list[str]) -> dict:
    """L4: exact median of the columns that hold a null, which are all that need one (one count
    pass, then one distributed percentile pass over the long form of those); 0 for the others."""
    nulls = train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    some = [c for c in cols if nulls[c]]
    med = exact_percentiles(_long(train, some), "x", [0.5], by=["feature"]).collect() if some else []
    found = {r["feature"]: r["value"] for r in med}
    return {c: found.get(c, 0.0) for c in cols}


def fit_scaler(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population std per column (a std of 0 scales by 1, as sklearn does)."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"] or 0.0, (row[f"s_{c}"] or 0.0) or 1.0) for c in cols}


LIN = "_lin_"   # prefix of the prepared model inputs: keys such as store_id stay untouched


@dataclass
class LinearPrep:
    levels: dict
    columns: list[str]
    medians: dict
    scale: dict

    @property
    def inputs(self) -> list[str]:
        return [LIN + c for c in self.columns]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the one-hot, imputed and standardised inputs as new ``_lin_*`` columns."""
        onehot = one_hot_columns(self.levels)
        exprs = {}
        for c in self.columns:
            m, s = self.scale[c]
            src = onehot[c] if c in onehot else F.col(c).cast("double")
            x = F.coalesce(src, F.lit(float(self.medians[c])))
            exprs[LIN + c] = (x - F.lit(float(m))) / F.lit(float(s))
        return df.withColumns(exprs)


def fit_linear_prep(train: DataFrame) -> LinearPrep:
    levels = {c: category_levels(train, c) for c in CATEGORICAL}
    encoded = train.withColumns(one_hot_columns(levels))
    cols = numeric_inputs(train) + list(one_hot_columns(levels))
    med = fit_medians(encoded, numeric_inputs(train)) | dict.fromkeys(one_hot_columns(levels), 0.0)
    imputed = encoded.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(med[c]))) for c in cols})
    return LinearPrep(levels, cols, med, fit_scaler(imputed, cols))


# -- E14 / T11: contiguous folds ------------------------------------------------------------------

def contiguous_folds(df: DataFrame, k: int = 5, order=KEYS) -> DataFrame:
    """Fold of each row when rows sorted by ``order`` are cut into k contiguous blocks
    (the first n % k blocks one row longer, as an unshuffled k-fold split does).
    Positions come from range partitions plus per-partition offsets (no global window)."""
    pos_df = global_positions(df, order, "_pos")
    n = df.agg(F.count(F.lit(1))).scalar()
    pos = F.col("_pos")
    big = (n / k).cast("long") + 1
    n_big = n % k
    fold = F.when(pos < n_big * big, (pos / big).cast("long")).otherwise(
        n_big + ((pos - n_big * big) / (big - 1)).cast("long"))
    return pos_df.withColumn("fold", fold.cast("int")).drop("_pos")


# -- L6: ridge via per-fold sufficient statistics ---------------------------------------------------

def fold_statistics(df: DataFrame, cols: list[str], label: str, fold_col: str = "fold") -> dict:
    """{fold: (G, b, yy)} with G = A'A, b = A'y, A = [1, X]; one pass over the rows."""
    p = len(cols)
    width = (p + 1) * (p + 1) + (p + 1) + 1

    def partial(batches):
        acc = {}
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            y = pdf[label].to_numpy(dtype=float)
            f = pdf[fold_col].to_numpy()
            for k in np.unique(f):
                m = f == k
                a = np.hstack([np.ones((int(m.sum()), 1)), x[m]])
                vec = np.concatenate([(a.T @ a).ravel(), a.T @ y[m], [y[m] @ y[m]]])
                acc[int(k)] = acc.get(int(k), 0) + vec
        if acc:
            yield pd.DataFrame({"fold": list(acc), "stats": [v.tolist() for v in acc.values()]})

    part = df.select(*[F.col(c).cast("double") for c in cols], F.col(label).cast("double"), fold_col) \
             .where(F.col(label).isNotNull()) \
             .mapInPandas(partial, "fold int, stats array<double>")
    cells = (part.select("fold", F.posexplode("stats").alias("i", "v"))
                 .groupBy("fold", "i").agg(F.sum("v").alias("v")))
    out = {}
    for r in cells.collect():   # folds x width values: bounded by the feature count
        out.setdefault(r["fold"], np.zeros(width))[r["i"]] = r["v"]
    stats = {}
    for k, v in out.items():
        g = v[:(p + 1) ** 2].reshape(p + 1, p + 1)
        b = v[(p + 1) ** 2:(p + 1) ** 2 + p + 1]
        stats[k] = (g, b, v[-1])
    return stats


def ridge_solve(g: np.ndarray, b: np.ndarray, alpha: float):
    """Ridge with an unpenalised intercept, from A'A and A'y (A = [1, X])."""
    n = g[0, 0]
    sx, xx = g[0, 1:], g[1:, 1:]
    sy, xy = b[0], b[1:]
    cxx = xx - np.outer(sx, sx) / n
    cxy = xy - sx * sy / n
    w = np.linalg.solve(cxx + alpha * np.eye(len(sx)), cxy)
    return sy / n - sx @ w / n, w


def sse(g, b, yy, intercept, w) -> float:
    beta = np.concatenate([[intercept], w])
    return float(yy - 2 * beta @ b + beta @ g @ beta)


def ridge_cv(stats: dict, alphas=RIDGE_ALPHAS):
    """Mean fold MSE per alpha (first alpha wins ties), refit on all folds."""
    total_g = sum(s[0] for s in stats.values())
    total_b = sum(s[1] for s in stats.values())
    scores = []
    for a in alphas:
        mses = []
        for k, (g, b, yy) in sorted(stats.items()):
            c, w = ridge_solve(total_g - g, total_b - b, a)
            mses.append(sse(g, b, yy, c, w) / g[0, 0])
        scores.append(float(np.mean(mses)))
    best = alphas[int(np.argmin(scores))]
    c, w = ridge_solve(total_g, total_b, best)
    return best, scores, c, w


@dataclass
class RidgeModel:
    prep: LinearPrep
    alpha: float
    intercept: float
    coef: np.ndarray
    cv_scores: list

    def prediction(self) -> F.Column:
        terms = [F.col(c) * F.lit(float(wi)) for c, wi in zip(self.prep.inputs, self.coef)]
        return F.lit(float(self.intercept)) + sum(terms[1:], terms[0])

    @property
    def inputs(self) -> list[str]:
        return self.prep.columns

    def predict(self, df: DataFrame, keep=KEYS) -> DataFrame:
        t = self.prep.transform(df)
        return t.select(*keep, self.prediction().alias("predicted_sales"))


def fit_ridge(train: DataFrame, alphas=RIDGE_ALPHAS, folds: int = 5) -> RidgeModel:
    # several passes follow (levels, medians, scaler, statistics): cut the lineage once
    train = durable(train.select(*KEYS, *[c for c in MODEL_INPUTS if c not in KEYS], TARGET))
    prep = fit_linear_prep(train)
    scaled = contiguous_folds(prep.transform(train), folds)
    if folds * (len(prep.inputs) + 1) ** 2 > MOST_CELLS:
        alpha, scores, c, w = ridge_by_gradient(scaled, prep.inputs, TARGET, alphas, folds)
    else:
        alpha, scores, c, w = ridge_cv(fold_statistics(scaled, prep.inputs, TARGET), alphas)
    return RidgeModel(prep, alpha, c, w, scores)


#: Cells of the per-fold products that tasks and driver may hold (8 bytes each); with more
#: inputs the fits go by gradient, whose memory grows with the inputs, not their square.
MOST_CELLS = 20_000_000


def ridge_by_gradient(df: DataFrame, cols: list[str], label: str, alphas, folds: int, fold_col: str = "fold"):
    """The same choice and fit as ``ridge_cv`` by distributed l-bfgs: (alpha, scores, intercept, coefficients)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    y = F.col(label).cast("double")
    data = durable(VectorAssembler(inputCols=cols, outputCol="features").transform(
        df.where(F.col(label).isNotNull()).withColumn(label, y)).select("features", label, fold_col))

    def fit(rows, alpha):
        # Spark penalises the mean squared error of the label scaled by its deviation, the ridge
        # formula the sum of the plain one
        n, spread = rows.agg(F.count(F.lit(1)), F.stddev_samp(label)).first()
        return LinearRegression(featuresCol="features", labelCol=label, regParam=alpha * (spread or 1.0) / n, elasticNetParam=0.0,
                                standardization=False, solver="l-bfgs", maxIter=500, tol=1e-10).fit(rows)

    def mse(model, rows):
        return model.transform(rows).agg(F.avg((F.col(label) - F.col("prediction")) ** 2)).first()[0]

    scores = [float(np.mean([mse(fit(data.where(F.col(fold_col) != k), a), data.where(F.col(fold_col) == k))
                             for k in range(folds)])) for a in alphas]
    alpha = alphas[int(np.argmin(scores))]
    best = fit(data, alpha)
    return alpha, scores, float(best.intercept), best.coefficients.toArray()


# -- L7-L10: boosted trees ------------------------------------------------------------------------------

# Three parameter families standing in for the three boosting libraries
GBT_FAMILIES = {
    "GBT leaf-wise": [dict(maxDepth=5, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.9"),
                      dict(maxDepth=6, stepSize=0.03, subsamplingRate=0.7, featureSubsetStrategy="0.8"),
                      dict(maxDepth=4, stepSize=0.1, subsamplingRate=0.85, featureSubsetStrategy="0.95")],
    "GBT ordered": [dict(maxDepth=6, stepSize=0.05), dict(maxDepth=8, stepSize=0.03),
                    dict(maxDepth=4, stepSize=0.1)],
    "GBT level-wise": [dict(maxDepth=6, stepSize=0.05, subsamplingRate=0.8),
                       dict(maxDepth=8, stepSize=0.03, subsamplingRate=0.7),
                       dict(maxDepth=4, stepSize=0.1, subsamplingRate=0.9)],
}
MISSING = -1.0e9   # sentinel for absent lags: trees split it off on its own


def tree_frame(df: DataFrame) -> DataFrame:
    """Numeric inputs with the sentinel for nulls; dept and store type as text, to be indexed as
    categories (a null type is a level of its own)."""
    exprs = {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in numeric_inputs(df)}
    exprs |= {f"{c}_level": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TREE_CATEGORIES}
    return df.withColumns(exprs)


TREE_CATEGORIES = ("store_type", "dept_id")


def tree_inputs(df: DataFrame) -> list[str]:
    return numeric_inputs(df) + [f"{c}_index" for c in TREE_CATEGORIES]


def patience_stop(errors: list[float], patience: int) -> tuple[int, bool]:
    """(rounds of the lowest error, whether ``patience`` rounds passed without a lower one)."""
    best = 0
    for k, e in enumerate(errors):
        if e < errors[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def tree_prep(train: DataFrame):
    """The fitted stages before the trees: categories as nominal features (levels unseen in training
    are one more level) and the input vector; and the bins that the largest category needs."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    names = [f"{c}_level" for c in TREE_CATEGORIES]
    index = StringIndexer(inputCols=names, outputCols=[f"{c}_index" for c in TREE_CATEGORIES],
                          handleInvalid="keep", stringOrderType="alphabetAsc")
    prep = Pipeline(stages=[index, VectorAssembler(inputCols=tree_inputs(train), outputCol="features")]).fit(train)
    return prep, max(TREE_BINS, max(map(len, prep.stages[0].labelsArray)) + 2)


#: Bins of a numeric input: the most for which their edges need 10,000 sampled rows, whatever the table.
TREE_BINS = 100
#: Rounds between two checkpoints of the rows' state, and between two looks at the held rows' errors.
STATE_ROUNDS = 20


@dataclass
class GridPoint:
    """One fit of a grid: its parameters, trees and the held rows' error after each round."""
    params: dict
    trees: list
    errors: list

    def __post_init__(self):
        unknown = set(self.params) - {"maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy"}
        if unknown:
            raise ValueError(f"unknown parameters of a boosted fit: {sorted(unknown)}")
        subset = self.params.get("featureSubsetStrategy", "all")
        self.depth, self.rate = int(self.params.get("maxDepth", 5)), float(self.params.get("subsamplingRate", 1.0))
        self.share = 1.0 if subset == "all" else float(subset)

    def weight(self, k: int) -> float:
        return float(self.params["stepSize"]) if k else 1.0


class BoostedGrid:
    """Boosted fits of several parameter sets on the same rows that go on together: every row is kept with
    its bins and its current score in each fit, a round grows one tree of each fit on the residuals, and
    no round is ever fitted twice.  A level of all the round's trees is one Spark job: tasks fold their
    rows into histograms, Spark sums those, and the best splits come back.

    The first tree is fitted to the target itself and counts whole, the others count ``stepSize``
    each, as in Spark's own boosting.  With ``held`` rows their error after every round is known."""

    def __init__(self, rows: DataFrame, grid: list[dict], bins: int, seed: int, held: DataFrame | None = None):
        self.points = [GridPoint(dict(params), [], []) for params in grid]
        rows, held = (None if x is None else x.where(F.col(TARGET).isNotNull()).select("features", TARGET) for x in (rows, held))
        self.session, self.seed, self.held = rows.sparkSession, seed, held is not None
        self.bins, n = tg.fit_bins(rows, bins, seed)
        n += held.count() if self.held else 0
        self.cores = self.session.sparkContext.defaultParallelism
        self.tasks = max(min(self.cores, -(-n // tg.LEAST_ROWS)), -(-n // tg.MOST_ROWS))
        kind, points = self.bins.dtype, len(grid)
        packed = durable(tg.blocks(rows, held, TARGET, self.bins, self.tasks))
        self.tasks = packed.rdd.getNumPartitions()
        self.state = packed.rdd.map(lambda row: tg.unpacked(row, kind, points)).persist()

    def _allowed(self, g: int, k: int, level: int):
        """The features that each open node may be split by, or None for all."""
        point, width = self.points[g], len(self.bins.edges)
        take = int(np.ceil(point.share * width))
        if take >= width:
            return None
        order = np.random.default_rng((self.seed + k, level)).random((2 ** level, width)).argsort(1)
        out = np.zeros((2 ** level, width), bool)
        np.put_along_axis(out, order[:, :take], True, 1)
        return out[point.trees[k].open() - (2 ** level - 1)]

    def _grow(self, state, k: int, active: list[int]) -> None:
        """Tree ``k`` of the active fits, level by level."""
        bins, seed, width = self.bins, self.seed + k, len(self.bins.edges)
        for g in active:
            self.points[g].trees.append(tg.Tree(self.points[g].depth, bins.most))
        level = 0
        while growing := {g: (self.points[g].trees[k], self.points[g].rate) for g in active
                          if level < self.points[g].depth and len(self.points[g].trees[k].open())}:
            size = self.tasks * 12 * bins.cells * sum(len(tree.open()) for tree, _ in growing.values())
            pieces = min(width, self.cores * 4, -(-size // tg.DRIVER_BYTES))
            ends = [width * i // pieces for i in range(pieces + 1)]
            chunks = list(zip(ends[:-1], ends[1:]))
            allowed = {g: self._allowed(g, k, level) for g in growing}
            sums = state.mapPartitions(lambda part: tg.histograms(part, growing, seed, bins, chunks))
            found = tg.better_of(tg.gathered(sums, lambda i, hists: tg.best_splits(hists, chunks[i], bins, allowed), size, pieces))
            for g, (tree, _) in growing.items():
                tree.split(level, level + 1 == self.points[g].depth, *found[g])
            level += 1

    def grow(self, targets: list[int]) -> None:
        """Grow each fit to its number of trees in ``targets`` (fits that have as many stay)."""
        while active := [g for g, (p, t) in enumerate(zip(self.points, targets)) if len(p.trees) < t]:
            k = min(len(self.points[g].trees) for g in active)
            active = [g for g in active if len(self.points[g].trees) == k]
            self._stretch(k, min(k + STATE_ROUNDS, *(targets[g] for g in active)), active)

    def _stretch(self, first: int, last: int, active: list[int]) -> None:
        before, state, seed = self.state, self.state, self.seed
        for k in range(first, last):
            self._grow(state, k, active)
            if state is not before:
                old.unpersist()
            old = state
            new = {g: (self.points[g].trees[k], self.points[g].weight(k)) for g in active}
            state = old.mapPartitions(lambda part, new=new: tg.advanced(part, new)).persist()
        state.checkpoint()
        state.count()
        if old is not before:
            old.unpersist()
        self._tell(before, first, last, active)
        before.unpersist()
        self.state = state

    def _tell(self, before, first: int, last: int, active: list[int]) -> None:
        """Node statistics of the new trees and the held rows' error after each new round, in one pass."""
        stretch = {g: (first, self.points[g].trees[first:last], [self.points[g].weight(k) for k in range(first, last)], self.points[g].rate) for g in active}
        seed = self.seed
        size = self.tasks * (last - first) * 24 * sum(2 ** (self.points[g].depth + 1) for g in active)
        for told in tg.gathered(before.mapPartitions(lambda part: tg.replayed(part, stretch, seed)), lambda _, v: v, size, len(active)):
            for g, (leaves, errors) in told.items():
                for tree, stats in zip(stretch[g][1], leaves):
                    tree.told(stats)
                if self.held:
                    self.points[g].errors += [float(e / n) if n else float("inf") for e, n in errors]

    def until(self, rounds: int, patience: int) -> list[tuple[int, str]]:
        """Go on until ``patience`` rounds bring no lower error, or ``rounds`` are grown:
        (rounds of the lowest error, what stopped it) of each fit."""
        while True:
            ends = [patience_stop(p.errors, patience) if p.errors else (0, False) for p in self.points]
            if all(stopped or len(p.trees) >= rounds for p, (_, stopped) in zip(self.points, ends)):
                return [(kept, "patience" if stopped else "rounds") for kept, stopped in ends]
            self.grow([0 if stopped else min(len(p.trees) + STATE_ROUNDS, rounds) for p, (_, stopped) in zip(self.points, ends)])

    def model(self, g: int, kept: int):
        """The first ``kept`` trees of a fit as one Spark model: it predicts, tells importances and can be saved."""
        point = self.points[g]
        return tg.spark_model(self.session, point.trees[:kept], [point.weight(k) for k in range(kept)], self.bins)

    def close(self) -> None:
        self.state.unpersist()


class Boosting:
    """A single boosted fit that goes on (see ``BoostedGrid``)."""

    def __init__(self, rows: DataFrame, params: dict, bins: int, seed: int, held: DataFrame | None = None):
        self.grid = BoostedGrid(rows, [params], bins, seed, held)
        self.trees, self.errors = self.grid.points[0].trees, self.grid.points[0].errors

    def advance(self, rounds: int) -> None:
        """Grow ``rounds`` more trees."""
        self.grid.grow([len(self.trees) + rounds])

    def until(self, rounds: int, patience: int) -> tuple[int, str]:
        return self.grid.until(rounds, patience)[0]

    def model(self, kept: int):
        """The first ``kept`` trees."""
        return self.grid.model(0, kept)


def _tree_target(df: DataFrame) -> DataFrame:
    return tree_frame(df).withColumn(TARGET, F.col(TARGET).cast("double"))


@dataclass
class FittedTrees:
    model: object               # PipelineModel: categories, vector, trees
    params: dict
    rmse: float                 # of the validation rows
    log: list                   # (params, rounds kept, rounds grown, what stopped it) of every grid point

    @property
    def trees(self) -> int:
        return tree_count(self.model)


def fit_gbt_families(train: DataFrame, val: DataFrame, families, rounds: int, patience: int, seed: int = 42) -> dict[str, FittedTrees]:
    """Every grid point of every family is grown until patience on ``val`` ends it; of each family
    the one of the lowest validation RMSE stays, cut at its best round.  Rows are prepared once for
    all grid points, and no round is grown twice."""
    from pyspark.ml import PipelineModel

    tr, va = _tree_target(train), _tree_target(val)
    prep, bins = tree_prep(durable(tr))
    tr, va = (durable(prep.transform(x).select("features", TARGET)) for x in (tr, va))
    grid = [(family, params) for family in families for params in GBT_FAMILIES[family]]

    fits = BoostedGrid(tr, [params for _, params in grid], bins, seed, va)
    ends = fits.until(rounds, patience)
    out = {}
    for family in families:
        mine = [g for g, (f, _) in enumerate(grid) if f == family]
        g = min(mine, key=lambda i: fits.points[i].errors[ends[i][0] - 1])
        kept = ends[g][0]
        out[family] = FittedTrees(PipelineModel([*prep.stages, fits.model(g, kept)]), grid[g][1], fits.points[g].errors[kept - 1] ** 0.5,
                                  [(grid[i][1], ends[i][0], len(fits.points[i].trees), ends[i][1]) for i in mine])
    fits.close()
    return out


def gbt_predict(model, df: DataFrame, keep=KEYS) -> DataFrame:
    return model.transform(tree_frame(df)).select(*keep, F.col("prediction").alias("predicted_sales"))


@dataclass
class TreeModel:
    """A fitted pipeline of trees with the interface of the other models."""
    pipeline: object

    @property
    def inputs(self) -> list[str]:
        return list(self.pipeline.stages[1].getInputCols())

    def predict(self, df: DataFrame, keep=KEYS) -> DataFrame:
        return gbt_predict(self.pipeline, df, keep)


@dataclass
class EnsembleModel:
    """The weighted sum of its members' predictions (equal weights: the simple mean)."""
    members: dict
    weights: dict

    @property
    def inputs(self) -> list[str]:
        return list(self.weights)

    def predict(self, df: DataFrame, keep=KEYS) -> DataFrame:
        """Each member adds its prediction as a column, so no rows are joined or shuffled; each sees the
        row as it came, not as another member has prepared it."""
        out, done = df.select(F.struct("*").alias("_row")), []
        for i, model in enumerate(self.members.values()):
            seen = out.select("_row.*", "_row", *done)
            out = model.predict(seen, keep=["_row", *done]).withColumnRenamed("predicted_sales", f"_member_{i}")
            done.append(f"_member_{i}")
        total = sum((F.col(c) * F.lit(float(self.weights[n])) for c, n in zip(done, self.members)), F.lit(0.0))
        return out.select(*[f"_row.{c}" for c in keep], total.alias("predicted_sales"))


def feature_importance(model, df: DataFrame) -> DataFrame:
    """(feature, importance) of a fitted pipeline's tree stage (p rows)."""
    imp = model.stages[-1].featureImportances.toArray()
    cols = tree_inputs(tree_frame(df))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)],
                                           "feature string, importance double")


def refit_gbts(train_val: DataFrame, chosen: dict[str, FittedTrees], seed: int = 42) -> dict:
    """L18 for trees: the chosen parameters of each family, grown on train + val for as many rounds as the
    early-stopped fit kept (no validation rows are left to stop on)."""
    from pyspark.ml import PipelineModel

    rows = _tree_target(train_val)
    prep, bins = tree_prep(durable(rows))
    rows = durable(prep.transform(rows).select("features", TARGET))

    fits = BoostedGrid(rows, [c.params for c in chosen.values()], bins, seed)
    rounds = [max(1, c.trees) for c in chosen.values()]
    fits.grow(rounds)
    out = {family: PipelineModel([*prep.stages, fits.model(g, n)]) for g, (family, n) in enumerate(zip(chosen, rounds))}
    fits.close()
    return out


def tree_count(model) -> int:
    return model.stages[-1].getNumTrees
