"""Exact percentiles against numpy, ridge CV against a direct solve, contiguous folds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions.quantiles import exact_percentiles
from tillcast.operators import models as md


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.integers(-50, 50, size=3000).astype(float)
    groups = rng.integers(0, 4, size=3000)
    rows = [(int(g), float(v)) for g, v in zip(groups, vals)] + [(9, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_percentiles(df, "x", probs, by=["g"]).collect()}
    for g in range(4):
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(vals[groups == g], p))
    assert not any(k[0] == 9 for k in got)                  # all-null group: no row
    whole = {r["prob"]: r["value"] for r in exact_percentiles(df, "x", [0.5]).collect()}
    assert whole[0.5] == pytest.approx(np.median(vals))


def test_ridge_cv_matches_direct_solution(spark):
    rng = np.random.default_rng(3)
    n, p = 203, 4
    x = rng.normal(size=(n, p))
    y = x @ np.array([1.0, -2.0, 0.5, 0.0]) + 3 + rng.normal(scale=0.3, size=n)
    folds = np.concatenate([np.full(s, k) for k, s in enumerate([41, 41, 41, 40, 40])])
    cols = [f"x{i}" for i in range(p)]
    rows = [tuple(map(float, x[i])) + (float(y[i]), int(folds[i])) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", y double, fold int")
    stats = md.fold_statistics(df, cols, "y")
    alphas = (0.1, 10.0)
    best, scores, c, w = md.ridge_cv(stats, alphas)

    def fit(xs, ys, a):
        xm, ym = xs.mean(0), ys.mean()
        coef = np.linalg.solve((xs - xm).T @ (xs - xm) + a * np.eye(p), (xs - xm).T @ (ys - ym))
        return ym - xm @ coef, coef

    for a, s in zip(alphas, scores):
        mses = []
        for k in range(5):
            tr, te = folds != k, folds == k
            ci, wi = fit(x[tr], y[tr], a)
            mses.append(np.mean((y[te] - x[te] @ wi - ci) ** 2))
        assert s == pytest.approx(np.mean(mses), rel=1e-9)
    c0, w0 = fit(x, y, best)
    assert c == pytest.approx(c0) and w == pytest.approx(w0)


def test_contiguous_folds(spark):
    rows = [(s, 1, d) for s in (1, 2) for d in range(11)]     # 22 rows -> sizes 5,5,4,4,4
    df = spark.createDataFrame(rows, "store_id int, dept_id int, week_date int")
    f = md.contiguous_folds(df, 5)
    sizes = {r["fold"]: r["n"] for r in f.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {0: 5, 1: 5, 2: 4, 3: 4, 4: 4}
    first = f.where((F.col("store_id") == 2) & (F.col("week_date") == 0)).first()["fold"]
    assert first == 2                                          # position 11


def test_ridge_by_gradient_equals_the_exact_solution(spark):
    from tillcast.operators import models as md
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    y = x @ [2.0, -1.0, 0.5] + 3 + rng.normal(size=200)
    rows = [(*map(float, r), float(t), i % 4) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int")
    alphas = (0.1, 10.0, 100.0)
    exact = md.ridge_cv(md.fold_statistics(df, ["a", "b", "c"], "y"), alphas)
    near = md.ridge_by_gradient(df, ["a", "b", "c"], "y", alphas, 4)
    assert near[0] == exact[0]
    np.testing.assert_allclose(near[1], exact[1], rtol=1e-4)
    np.testing.assert_allclose(near[3], exact[3], atol=1e-4)
    assert abs(near[2] - exact[2]) < 1e-4
