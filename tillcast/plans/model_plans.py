"""Registered queries: encoding, imputation, scaling, ridge, boosted trees, ensembles, selection,
refit and batch scoring (L2-L21, F8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.config import DEFAULT
from tillcast.functions.metrics import rounded
from tillcast.operators import baselines as bl
from tillcast.operators import ensemble as en
from tillcast.operators import evaluate as ev
from tillcast.operators import models as md
from tillcast.operators import scoring as sc
from tillcast.plans.feature_plans import FEATURE_CTES, shared_features
from tillcast.plans.forecast_plans import REPORT_CTES, VAL_CTES, all_val_predictions, metric_sql, train_val_test
from tillcast.plans.registry import register, with_base
from tillcast.schemas import KEYS
from tillcast.session import durable

P = DEFAULT
GATE = bl.SEASONAL_NAIVE
QUERY_ROUNDS, QUERY_PATIENCE = P.boosting_rounds, P.boosting_patience


def feature_splits(spark, sf):
    f = shared_features(spark, sf)
    return [f.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]


# -- L3-L5: SQL-checkable preprocessing ------------------------------------------------------------

@register("l3_one_hot", with_base(FEATURE_CTES + """,
tr AS (SELECT * FROM features WHERE split = 'train')""", """
SELECT store_id, dept_id, week_date, 'store_type_' || store_type AS feature FROM features
WHERE store_type IN (SELECT store_type FROM tr) AND store_type <> (SELECT MIN(store_type) FROM tr)
UNION ALL
SELECT store_id, dept_id, week_date, 'dept_id_' || CAST(dept_id AS VARCHAR) FROM features
WHERE dept_id IN (SELECT dept_id FROM tr) AND dept_id <> (SELECT MIN(dept_id) FROM tr)"""))
def q_one_hot(spark, sf):
    """L3: one indicator per level but the first (levels from train); unseen levels all zero.
    Long form: one row per (row, indicator set to 1)."""
    f = shared_features(spark, sf)
    train = f.where(F.col("split") == "train")
    levels = {c: md.category_levels(train, c) for c in md.CATEGORICAL}
    oh = md.one_hot_columns(levels)
    wide = f.select(*KEYS, *[e.alias(n) for n, e in oh.items()])
    arr = F.array(*[F.when(F.col(n) == 1, F.lit(n)) for n in oh])
    return wide.select(*KEYS, F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("feature"))


NUMERIC = [c for c in md.MODEL_INPUTS if c not in md.CATEGORICAL]


@register("l4_median_imputation", with_base(FEATURE_CTES + """,
tr AS (SELECT * FROM features WHERE split = 'train')""", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM tr" for c in NUMERIC)
    + ") WHERE median IS NOT NULL"))
def q_medians(spark, sf):
    """L4: exact train median of every numeric model input (one distributed pass)."""
    train, _, _ = feature_splits(spark, sf)
    long = md._long(train, NUMERIC)
    from tillcast.functions.quantiles import exact_percentiles
    return exact_percentiles(long, "x", [0.5], by=["feature"]).select("feature", F.col("value").alias("median"))


@register("l5_standardisation", with_base(FEATURE_CTES + """,
tr AS (SELECT * FROM features WHERE split = 'train'),
med AS (SELECT """ + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in NUMERIC) + """ FROM tr),
imp AS (SELECT """ + ", ".join(f"COALESCE(CAST(tr.{c} AS DOUBLE), med.{c}) AS {c}" for c in NUMERIC) + """ FROM tr, med)""",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_POP({c}), 4) AS std FROM imp" for c in NUMERIC)
    + ")"))
def q_scaler(spark, sf):
    """Mean and population std of the median-imputed train inputs."""
    train, _, _ = feature_splits(spark, sf)
    med = md.fit_medians(train, NUMERIC)
    imp = train.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(med[c]))) for c in NUMERIC})
    long = md._long(imp, NUMERIC)
    return long.groupBy("feature").agg(F.round(F.avg("x"), 4).alias("mean"), F.round(F.stddev_pop("x"), 4).alias("std"))


# -- L6, L11: ridge (rows-only: iterative fit) ----------------------------------------------------------

def ridge_on(spark, sf):
    train, val, test = feature_splits(spark, sf)
    return md.fit_ridge(train, md.RIDGE_ALPHAS, P.ridge_folds), train, val, test


@register("l6_ridge_cv")
def q_ridge_cv(spark, sf):
    """Mean contiguous-5-fold MSE per alpha from one pass of per-fold statistics; chosen alpha flagged."""
    model, *_ = ridge_on(spark, sf)
    rows = [(float(a), float(s), bool(a == model.alpha)) for a, s in zip(md.RIDGE_ALPHAS, model.cv_scores)]
    return spark.createDataFrame(rows, "alpha double, cv_mse double, chosen boolean")


@register("e14_contiguous_folds", with_base(FEATURE_CTES + """,
tr AS (SELECT *, ROW_NUMBER() OVER (ORDER BY store_id, dept_id, week_date) - 1 AS pos,
       COUNT(*) OVER () AS n FROM features WHERE split = 'train'),
fz AS (SELECT *, n // 5 + 1 AS big, n % 5 AS nbig FROM tr)""", """
SELECT CAST(CASE WHEN pos < nbig * big THEN pos // big ELSE nbig + (pos - nbig * big) // (big - 1) END AS INTEGER) AS fold,
  COUNT(*) AS n_rows, MIN(week_date) AS first_date FROM fz GROUP BY 1"""))
def q_folds(spark, sf):
    """Contiguous fold sizes without a global single-partition window over rows."""
    train, _, _ = feature_splits(spark, sf)
    f = md.contiguous_folds(train, P.ridge_folds)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.min("week_date").alias("first_date"))


@register("l11_ridge_val_metrics")
def q_ridge_metrics(spark, sf):
    """Validation metrics of the ridge model (clipped target, as the feature table holds)."""
    model, _, val, _ = ridge_on(spark, sf)
    return rounded(ev.evaluate_predictions(val, model.predict(val), with_wmae=True, params=P))


# -- L7-L10: boosted trees (rows-only) ---------------------------------------------------------------------

def _gbt_query(family):
    def q(spark, sf):
        train, val, _ = feature_splits(spark, sf)
        fitted = md.fit_gbt_families(train, val, [family], QUERY_ROUNDS, QUERY_PATIENCE)[family]
        m = rounded(ev.evaluate_predictions(val, md.gbt_predict(fitted.model, val), with_wmae=True, params=P))
        _, kept, grown, why = next(x for x in fitted.log if x[0] == fitted.params)
        return m.select(F.lit(family).alias("model"), F.lit(str(fitted.params)).alias("params"), F.lit(kept).alias("n_trees"),
                        F.lit(grown).alias("rounds_fitted"), F.lit(why).alias("stopped"), "*")
    q.__doc__ = f"{family}: three-point grid, early stopping by patience on validation rows, best by val RMSE"
    return q


register("l7_gbt_leaf_wise")(_gbt_query("GBT leaf-wise"))
register("l8_gbt_ordered")(_gbt_query("GBT ordered"))
register("l9_gbt_level_wise")(_gbt_query("GBT level-wise"))


@register("l10_feature_importance")
def q_importance(spark, sf):
    """Importances of the best fit of each of the three families."""
    train, val, _ = feature_splits(spark, sf)
    fitted = md.fit_gbt_families(train, val, list(md.GBT_FAMILIES), QUERY_ROUNDS, QUERY_PATIENCE)
    out = None
    for family, f in fitted.items():
        one = md.feature_importance(f.model, train).select(F.lit(family).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# -- L12-L17, F8 on baseline forecasts (SQL-checkable) ---------------------------------------------------

ENS_CTES = VAL_CTES + """,
m AS (SELECT p.model, a.store_id, a.dept_id, a.week_date, a.weekly_sales, a.isholiday, p.predicted_sales
      FROM va a JOIN predsn p USING (store_id, dept_id, week_date)),
r AS (SELECT model, """ + metric_sql() + """ FROM m GROUP BY model),
g AS (SELECT rmse AS g_rmse, wmae AS g_wmae FROM r WHERE model = '""" + GATE + """'),
mem0 AS (SELECT r.* FROM r, g WHERE r.model <> '""" + GATE + """' AND r.rmse < g.g_rmse AND r.wmae < g.g_wmae),
mem AS (SELECT * FROM mem0 WHERE (SELECT COUNT(*) FROM mem0) >= 2),
wts AS (SELECT model, (1.0 / rmse) / (SELECT SUM(1.0 / rmse) FROM mem) AS weight FROM mem),
es AS (SELECT store_id, dept_id, week_date, AVG(predicted_sales) AS predicted_sales FROM predsn
       WHERE model IN (SELECT model FROM mem) GROUP BY 1, 2, 3 HAVING COUNT(*) = (SELECT COUNT(*) FROM mem)),
ew AS (SELECT p.store_id, p.dept_id, p.week_date, SUM(p.predicted_sales * w.weight) AS predicted_sales
       FROM predsn p JOIN wts w USING (model) GROUP BY 1, 2, 3 HAVING COUNT(*) = (SELECT COUNT(*) FROM mem)),
ms AS (SELECT """ + metric_sql() + """ FROM va a JOIN es USING (store_id, dept_id, week_date)),
mw AS (SELECT """ + metric_sql() + """ FROM va a JOIN ew USING (store_id, dept_id, week_date))"""


def baseline_metrics(spark, sf):
    """Forecasts, actuals and one metric row per model, each materialised once: gate, weights,
    choice and selection all read the few metric rows again and again."""
    preds, val = all_val_predictions(spark, sf)
    preds, val = durable(preds), durable(val)
    return preds, val, durable(rounded(ev.evaluate_predictions(val, preds, by=["model"], with_wmae=True, params=P)))


@register("l12_ensemble_members", with_base(ENS_CTES, "SELECT model, rmse, wmae FROM mem"))
def q_members(spark, sf):
    _, _, r = baseline_metrics(spark, sf)
    return en.ensemble_members(r, GATE).select("model", "rmse", "wmae")


@register("l13_simple_ensemble", with_base(ENS_CTES, """
SELECT store_id, dept_id, week_date, ROUND(predicted_sales, 6) AS predicted_sales FROM es"""))
def q_simple(spark, sf):
    """L13 (a mean of four values often ends in 5 at the 5th place: compared at 6 places)."""
    preds, _, r = baseline_metrics(spark, sf)
    e = en.simple_mean(preds, en.ensemble_members(r, GATE))
    return e.withColumn("predicted_sales", F.round("predicted_sales", 6))


@register("l14_weighted_ensemble", with_base(ENS_CTES, """
SELECT store_id, dept_id, week_date, ROUND(predicted_sales, 4) AS predicted_sales FROM ew"""))
def q_weighted(spark, sf):
    preds, _, r = baseline_metrics(spark, sf)
    e = en.weighted_mean(preds, en.ensemble_members(r, GATE))
    return e.withColumn("predicted_sales", F.round("predicted_sales", 4))


@register("l15_ensemble_choice", with_base(ENS_CTES, """
SELECT CASE WHEN mw.rmse < ms.rmse THEN 'weighted' ELSE 'simple' END AS ensemble_method,
  LEAST(mw.rmse, ms.rmse) AS rmse FROM ms, mw"""))
def q_choice(spark, sf):
    preds, val, r = baseline_metrics(spark, sf)
    mem = durable(en.ensemble_members(r, GATE))
    m = durable(rounded(ev.evaluate_predictions(val, en.both_means(preds, mem), by=["model"], with_wmae=True, params=P)))
    simple, weighted = (m.where(F.col("model") == c) for c in ("simple", "weighted"))
    # without members there is no ensemble, but still a row that says so
    none = m.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0").select(F.lit("simple").alias("ensemble_method"), F.lit(None).cast("double").alias("rmse"))
    return en.choose_ensemble(simple, weighted).unionByName(none)


@register("l17_model_selection", with_base(ENS_CTES, """
SELECT COALESCE((SELECT arg_min(model, (rmse, model)) FROM mem0),
    (SELECT arg_min(model, (rmse, model)) FROM r WHERE model <> '""" + GATE + """')) AS best_model,
  (SELECT COUNT(*) FROM mem0) > 0 AS beats_gate"""))
def q_select(spark, sf):
    _, _, r = baseline_metrics(spark, sf)
    return en.select_best(r, GATE)


@register("f8_top_two_models", with_base(ENS_CTES, "SELECT model, rmse FROM r WHERE model <> '" + GATE + "' ORDER BY rmse, model LIMIT 2"))
def q_top_two(spark, sf):
    _, _, r = baseline_metrics(spark, sf)
    return en.top_two(r, GATE).select("model", "rmse")


@register("l16_top_two_ensemble", with_base(ENS_CTES + """,
t2 AS (SELECT model FROM r WHERE model <> '""" + GATE + """' ORDER BY rmse, model LIMIT 2),
mem2 AS (SELECT * FROM mem0 WHERE model IN (SELECT model FROM t2)),
e2 AS (SELECT store_id, dept_id, week_date, AVG(predicted_sales) AS predicted_sales FROM predsn
       WHERE model IN (SELECT model FROM mem2) GROUP BY 1, 2, 3 HAVING COUNT(*) = (SELECT COUNT(*) FROM mem2))""",
"SELECT " + metric_sql() + " FROM va a JOIN e2 USING (store_id, dept_id, week_date) HAVING (SELECT COUNT(*) FROM mem2) >= 2"))
def q_top_two_ens(spark, sf):
    """Ensemble of the gate-beating members among the two best results (none if fewer than 2)."""
    preds, val, r = baseline_metrics(spark, sf)
    mem = en.gate_members(r, GATE).join(en.top_two(r, GATE).select("model"), "model", "left_semi")
    e = en.simple_mean(preds, mem)
    m = rounded(ev.evaluate_predictions(val, e, with_wmae=True, params=P))
    return m.where(mem.agg(F.count(F.lit(1))).scalar() >= 2)


# -- L18-L21: refit, comparison, batch scoring (rows-only) ----------------------------------------------

@register("l18_refit_test_metrics")
def q_refit(spark, sf):
    """Ridge refit on train + val with the alpha chosen on train, scored on test."""
    chosen, train, val, test = ridge_on(spark, sf)
    model = md.fit_ridge(train.unionByName(val), [chosen.alpha], P.ridge_folds)
    return rounded(ev.evaluate_predictions(test, model.predict(test), with_wmae=True, params=P))


@register("l19_l20_model_comparison")
def q_comparison(spark, sf):
    """Validation metrics of baselines, ridge and the baseline ensemble in one frame."""
    preds, val_raw, r = baseline_metrics(spark, sf)
    mem = en.ensemble_members(r, GATE)
    ens = rounded(ev.evaluate_predictions(val_raw, en.weighted_mean(preds, mem), with_wmae=True, params=P))
    model, _, val, _ = ridge_on(spark, sf)
    ridge = rounded(ev.evaluate_predictions(val, model.predict(val), with_wmae=True, params=P))
    return (r.unionByName(ridge.withColumn("model", F.lit("Linear (Ridge)")))
             .unionByName(ens.withColumn("model", F.lit("Ensemble (weighted)"))))


@register("l21_batch_scoring")
def q_scoring(spark, sf):
    """Score the test feature rows as one batch, row id kept."""
    model, _, _, test = ridge_on(spark, sf)
    batch = test.withColumn("row_id", F.struct(*KEYS))

    def predict(typed):
        return model.predict(typed, keep=["row_id"])

    scored, rejected = sc.score_batch(batch, predict)
    return scored.select("row_id.*", "predicted_sales")


L19_CTES = REPORT_CTES + """,
m AS (SELECT p.model, a.weekly_sales, a.isholiday, p.predicted_sales FROM va a JOIN predsn p USING (store_id, dept_id, week_date)),
r AS (SELECT model, """ + metric_sql() + """ FROM m GROUP BY model),
g AS (SELECT rmse AS g_rmse, wmae AS g_wmae FROM r WHERE model = '""" + GATE + """'),
mem0 AS (SELECT r.* FROM r, g WHERE r.model <> '""" + GATE + """' AND r.rmse < g.g_rmse AND r.wmae < g.g_wmae),
mem AS (SELECT * FROM mem0 WHERE (SELECT COUNT(*) FROM mem0) >= 2),
wts AS (SELECT model, (1.0 / rmse) / (SELECT SUM(1.0 / rmse) FROM mem) AS weight FROM mem),
ewt AS (SELECT p.store_id, p.dept_id, p.week_date, SUM(p.predicted_sales * w.weight) AS predicted_sales
        FROM predsn_t p JOIN wts w USING (model) GROUP BY 1, 2, 3 HAVING COUNT(*) = (SELECT COUNT(*) FROM mem))"""


@register("l19_refit_ensemble_test", with_base(L19_CTES,
    "SELECT " + metric_sql() + " FROM va_t a JOIN ewt USING (store_id, dept_id, week_date)"))
def q_refit_ensemble(spark, sf):
    """Members chosen and weighted on validation, refit on train + val, combined on test."""
    train, val, test = train_val_test(spark, sf)
    gv = bl.forecast_grid(train, val, P)
    r = durable(rounded(ev.evaluate_predictions(val, bl.all_predictions(gv, P), by=["model"], with_wmae=True, params=P)))
    members = durable(en.ensemble_members(r, GATE))
    gt = bl.forecast_grid(train.unionByName(val), test, P)
    combined = en.weighted_mean(bl.all_predictions(gt, P), members)
    return rounded(ev.evaluate_predictions(test, combined, with_wmae=True, params=P))



@register("l18_gbt_refit_test_metrics")
def q_gbt_refit(spark, sf):
    """L18 (trees): the best grid point of each family chosen on validation, refit on train + val
    with its kept tree count, scored on test."""
    train, val, test = feature_splits(spark, sf)
    fitted = md.fit_gbt_families(train, val, list(md.GBT_FAMILIES), QUERY_ROUNDS, QUERY_PATIENCE)
    out = None
    for family, model in md.refit_gbts(train.unionByName(val), fitted).items():
        m = rounded(ev.evaluate_predictions(test, md.gbt_predict(model, test), with_wmae=True, params=P))
        one = m.select(F.lit(family).alias("model"), F.lit(md.tree_count(model)).alias("n_trees"), "*")
        out = one if out is None else out.unionByName(one)
    return out
