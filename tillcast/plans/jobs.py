"""Batch jobs mirroring the reference's stages, reading and writing tables in ``out``.

    python -m tillcast.plans.jobs --sf /root/testdata/sf0.01 --out <shared folder> [stage ...]

Stages: etl, split, features, eda, baselines, train, evaluate, score (default: all, in order).
Each stage reads what the previous one wrote (Parquet; predictions partitioned by model,
splits partitioned by split), so a stage can be re-run alone.  ``out`` must be a folder
every executor can reach (the same rule as ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.config import DEFAULT, Params
from tillcast.functions.metrics import rounded
from tillcast.operators import baselines as bl
from tillcast.operators import checks, eda, ensemble, evaluate, ingest, merge, models, scoring, segments
from tillcast.operators.features import appended_features, build_features, restated, tail_state
from tillcast.operators.split import with_split
from tillcast.schemas import DIM_DEPT, DIM_STORE, FACT, KEYS, VIEW_COLUMNS
from tillcast.session import durable
from tillcast.sources import fixtures, model_store, sinks, star_store
from tillcast.sources.raw import raw_from_view

STAGES = ["etl", "split", "features", "eda", "baselines", "train", "evaluate", "score"]
FACT_COLUMNS = ["store_id", "dept_id", "week_date", "weekly_sales", "isholiday", "temperature", "fuel_price",
                "markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi", "unemployment"]


def _p(out: str, *parts: str) -> str:
    return os.path.join(out, *parts)


def star_version(spark: SparkSession, out: str) -> int:
    """The newest published version of the star tables, 0 if there is none."""
    return star_store.published(spark, out)


def star_table(spark: SparkSession, out: str, name: str, version: int | None = None) -> DataFrame:
    version = star_version(spark, out) if version is None else version
    if name == "fact":
        return star_store.read_fact(spark, out, version)
    return spark.read.parquet(star_store.folder(out, version, name))


def stage_raw(spark: SparkSession, out: str, raw: tuple, batch: str) -> None:
    """Raw tables -> typed staging rows of one batch; staged again under the same name, it counts once."""
    for name, df in zip(("dim_store_stg", "dim_dept_stg", "fact_stg"), ingest.ingest(*raw)):
        star_store.stage(df, out, name, batch)


def etl(spark: SparkSession, sf_dir: str, out: str, params: Params = DEFAULT) -> DataFrame:
    """Staging cleared (A5), so that a load which failed leaves nothing in the way of the next -> raw
    tables staged -> merged, checked and published.  Returns the validation results (also written)."""
    star_store.clear_staging(spark, out)
    stage_raw(spark, out, raw_from_view(fixtures.analytics_view(spark, sf_dir)), "etl")
    return merge_staging(spark, out)


def etl_files(spark: SparkSession, out: str, stores: str, features: str, train: str, batch: str = "files") -> DataFrame:
    """The load from the raw CSV files themselves: lines that are no rows go to reports/refused_lines with
    their reasons, the rest is staged, merged, checked and published."""
    star_store.clear_staging(spark, out)
    staging, refused = ingest.ingest_lines(*(spark.read.text(p) for p in (stores, features, train)))
    refused.write.mode("overwrite").parquet(_p(out, "reports", "refused_lines"))
    for name, df in zip(("dim_store_stg", "dim_dept_stg", "fact_stg"), staging):
        star_store.stage(df, out, name, batch)
    return merge_staging(spark, out)


def merge_staging(spark: SparkSession, out: str) -> DataFrame:
    """K1-K4 on the stored star schema: checks on staging -> a new version -> checks -> published by one
    marker file -> staging cleared.

    The fact is rewritten in the months that staging touches and read in no other: a key lies in one
    month, dimensions only grow, so what the profiles in the manifest say of untouched months still
    holds.  Readers see a version only with its marker; a load that fails anywhere leaves the last
    published one as it was."""
    stores, depts, staged = (star_store.staged(spark, out, n) for n in ("dim_store_stg", "dim_dept_stg", "fact_stg"))
    refused = checks.staging_range_violations(staged)
    if not refused.isEmpty():
        refused.write.mode("overwrite").parquet(_p(out, "reports", "staging_violations"))
        raise ValueError("staged rows that the fact cannot hold: see reports/staging_violations")
    typed = staged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT.fields])
    base = star_version(spark, out)
    version = star_store.claim(spark, out)

    def current(name, schema):
        # the first run merges into an empty table, so its keys are checked like any other's
        return star_table(spark, out, name, base) if base else spark.createDataFrame([], schema)

    merge.upsert_store(current("dim_store", DIM_STORE), stores).write.mode("overwrite").parquet(star_store.folder(out, version, "dim_store"))
    merge.insert_missing_depts(current("dim_dept", DIM_DEPT), depts.where(F.col("dept_id").isNotNull())).write.mode("overwrite").parquet(
        star_store.folder(out, version, "dim_dept"))
    touched = [r[0] for r in typed.select(star_store.month_of()).distinct().collect()]      # months, whatever the rows
    dims = [star_table(spark, out, n, version) for n in ("dim_store", "dim_dept")]
    entries = star_store.manifest(spark, out, base).where(~F.col("month").isin(touched))
    if touched:
        star_store.write_fact(merge.upsert_fact(star_store.read_fact(spark, out, base, touched), typed, FACT_COLUMNS), out, version)
        new = checks.fact_profile(star_store.read_load(spark, out, version), *dims, by=["month"]).withColumn("load", F.lit(version))
        entries = entries.unionByName(new.select(*entries.columns))
    entries.coalesce(1).write.mode("overwrite").parquet(star_store.folder(out, version, "manifest"))     # a row a month
    total, n = checks.total_profile(star_store.manifest(spark, out, version)), F.count(F.lit(1))
    results = durable(checks.suite_rows(total, *[d.agg(n).scalar() for d in dims], n_view=F.col("view_rows")))
    results.write.mode("overwrite").parquet(_p(out, "reports", "validation"))
    if not checks.suite_summary(results).first()["all_passed"]:
        raise ValueError("the new star tables fail their checks and are not published: see reports/validation")
    star_store.publish(spark, out, version, base)
    star_store.clear_staging(spark, out)
    return results


def _view(fact: DataFrame, stores: DataFrame, depts: DataFrame) -> DataFrame:
    return fact.join(stores, "store_id").join(depts, "dept_id").select(*VIEW_COLUMNS)


def view_from_star(spark: SparkSession, out: str) -> DataFrame:
    """A11 over the published star tables, also registered as a view for SQL."""
    version = star_version(spark, out)
    v = _view(*(star_table(spark, out, n, version) for n in ("fact", "dim_store", "dim_dept")))
    v.createOrReplaceTempView("vw_sales_analytics")
    return v


def split(spark: SparkSession, out: str, params: Params = DEFAULT) -> None:
    sinks.write_splits(with_split(view_from_star(spark, out), params), _p(out, "splits"))


PART = "feature_month"       # ``month`` is a feature


def features(spark: SparkSession, out: str, params: Params = DEFAULT) -> None:
    """L1 in full: the feature table in folders by split and month, the state that later weeks need, and
    the star version that both hold."""
    version = star_version(spark, out)
    sv = spark.read.parquet(_p(out, "splits"))
    _write_features(build_features(sv, params), out)
    tail_state(sv, params).write.mode("overwrite").parquet(_p(out, "feature_state", "tail"))
    _features_are_at(spark, out, version)


def _write_features(rows: DataFrame, out: str, mode: str = "static") -> None:
    (rows.withColumn(PART, star_store.month_of()).repartitionByRange("split", PART, "store_id", "dept_id")
         .sortWithinPartitions("split", PART, *KEYS)
         .write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("split", PART).parquet(_p(out, "features")))


def _features_are_at(spark: SparkSession, out: str, version: int) -> None:
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").parquet(_p(out, "feature_state", "version"))


def read_features(spark: SparkSession, out: str) -> DataFrame:
    f = spark.read.parquet(_p(out, "features"))
    return f.select(*[c for c in f.columns if c not in (PART, "split")], "split")


def changed_rows(spark: SparkSession, out: str, since: int) -> DataFrame:
    """View rows of the newest star version that version ``since`` does not have, or not so: only the
    months that were written after it are read, in both."""
    now = star_version(spark, out)
    months = [r[0] for r in star_store.manifest(spark, out, now).where(F.col("load") > since).select("month").collect()]
    new, old = (star_store.read_fact(spark, out, v, months) for v in (now, since))
    dims = [star_table(spark, out, n, now) for n in ("dim_store", "dim_dept")]
    return _view(new.exceptAll(old), *dims)


def append_features(spark: SparkSession, out: str, params: Params = DEFAULT) -> int:
    """L1 after a load that appended weeks: features of the new rows from the stored state, written into the
    split and month folders that they touch; the state goes on.  A load that restated older weeks
    makes a rebuild.  Returns how many rows were computed, -1 for a rebuild."""
    since = spark.read.parquet(_p(out, "feature_state", "version")).first()[0]
    new = durable(with_split(changed_rows(spark, out, since), params))
    if new.isEmpty():
        return 0
    state = spark.read.parquet(_p(out, "feature_state", "tail"))
    if not restated(state, new).isEmpty():
        split(spark, out, params)
        features(spark, out, params)
        return -1
    made = durable(appended_features(state, new, params))
    folders = [(r[0], r[1]) for r in made.select("split", star_store.month_of()).distinct().collect()]     # months, whatever the rows
    there = spark.read.parquet(_p(out, "features"))
    mine = reduce(lambda a, b: a | b, [(F.col("split") == s) & (F.col(PART) == m) for s, m in folders])
    kept = there.where(mine).drop(PART).join(made.select(*KEYS), KEYS, "left_anti")
    # what the folders held is read before they are written anew
    _write_features(durable(kept.select(*made.columns).unionByName(made)), out, "dynamic")
    later = durable(tail_state(state.unionByName(new.select(*state.columns)), params))
    later.write.mode("overwrite").parquet(_p(out, "feature_state", "tail"))
    _features_are_at(spark, out, star_version(spark, out))
    return made.count()


def eda_tables(spark: SparkSession, out: str, params: Params = DEFAULT) -> None:
    v = spark.read.parquet(_p(out, "splits")).drop("split")
    stats = eda.series_statistics(v)
    tables = {
        "schema_sanity_summary": eda.sanity_summary(v),
        "weekly_total_sales": eda.weekly_totals(v),
        "sales_by_store_type": eda.sales_by_store_type(v),
        "top_stores_by_sales": eda.top_by_sales(v, "store_id", params.top_stores),
        "top_depts_by_sales": eda.top_by_sales(v, "dept_id", params.top_depts),
        "holiday_summary": eda.holiday_summary(v),
        "markdown_sales_comparison": eda.markdown_comparison(v),
        "markdown_availability_by_month": eda.markdown_by_month(v),
        "weeks_per_series": eda.weeks_per_series(v),
        "cold_start_series": eda.cold_start(v, params),
        "series_statistics": stats,
        "volatility_counts": eda.volatility_counts(stats),
        "dashboard_weekly_totals": eda.dashboard_weekly(v),
        "dashboard_store_weekly": eda.dashboard_store_weekly(v),
        "dashboard_dept_weekly": eda.dashboard_dept_weekly(v),
        "dashboard_top_depts_by_volume": eda.dept_volume_rank(v),
        "dashboard_top_depts_by_volatility": eda.dept_volatility_rank(stats),
    }
    for name, df in tables.items():
        sinks.write_csv(df, _p(out, "reports", "eda", name))


def baselines(spark: SparkSession, out: str, params: Params = DEFAULT) -> None:
    sv = spark.read.parquet(_p(out, "splits"))
    train = sv.where(F.col("split") == "train").drop("split")
    val = sv.where(F.col("split") == "val").drop("split")
    preds = bl.all_predictions(bl.forecast_grid(train, val, params), params)
    sinks.write_predictions(preds, _p(out, "predictions", "baselines_val"))
    preds = sinks.read_predictions(spark, _p(out, "predictions", "baselines_val"))
    overall = rounded(evaluate.evaluate_predictions(val, preds, by=["model"], with_wmae=True, params=params))
    overall.write.mode("overwrite").parquet(_p(out, "reports", "baseline_results"))
    segs = rounded(evaluate.evaluate_by_segments(segments.create_segments(val, params.top_segment_depts), preds,
                                                 ["store_type", "isholiday", "volume_quartile", "is_top_dept"],
                                                 by=["model"], params=params))
    segs.write.mode("overwrite").parquet(_p(out, "reports", "baseline_segments_all"))


def _ensemble(va: DataFrame, val_preds: DataFrame, test_preds: DataFrame, members: DataFrame, name: str, params: Params):
    """The simple or, if its validation RMSE is lower, the weighted mean of ``members`` (L13-L15):
    (validation metrics row, test predictions, its label from ``name`` and the method, weights by member);
    None without two members."""
    if members.isEmpty():
        return None
    m = durable(rounded(evaluate.evaluate_predictions(va, ensemble.both_means(val_preds, members), by=["model"], with_wmae=True, params=params)))
    found = {c: (m.where(F.col("model") == c).drop("model"), f) for c, f in (("simple", ensemble.simple_mean), ("weighted", ensemble.weighted_mean))}
    method = ensemble.choose_ensemble(found["simple"][0], found["weighted"][0]).first()["ensemble_method"]
    label = f"{name} ({method})"
    metrics, combine = found[method]
    names = [r["model"] for r in members.orderBy("model").collect()]
    weights = dict.fromkeys(names, 1 / len(names))
    if method == "weighted":
        weights = {r["model"]: r["weight"] for r in ensemble.inverse_rmse_weights(members).collect()}
    tag = F.lit(label).alias("model")
    return metrics.select(tag, "*"), combine(test_preds, members).select(tag, *KEYS, "predicted_sales"), label, weights


def train(spark: SparkSession, out: str, params: Params = DEFAULT) -> DataFrame:
    """Ridge and three tree families on the features; ensembles of the gate-beating trees and of the
    two best models, simple or weighted by validation RMSE; all refit on train + val (members and
    weights from validation) and predicted on test; selection; comparison table, prediction
    metadata and the final record with test metrics."""
    f = read_features(spark, out)
    tr, va, te = (f.where(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
    gate = spark.read.parquet(_p(out, "reports", "baseline_results"))
    ridge = models.fit_ridge(tr, models.RIDGE_ALPHAS, params.ridge_folds)
    both = tr.unionByName(va)
    refit_ridge = models.fit_ridge(both, [ridge.alpha], params.ridge_folds)
    val_preds = {"Linear (Ridge)": ridge.predict(va)}
    test_preds = {"Linear (Ridge)": refit_ridge.predict(te)}
    importance, stops = None, []
    fitted = models.fit_gbt_families(tr, va, list(models.GBT_FAMILIES), params.boosting_rounds, params.boosting_patience)
    refits = models.refit_gbts(both, fitted)
    for family, trees in fitted.items():
        stops += [(family, str(q), kept, grown, why) for q, kept, grown, why in trees.log]
        val_preds[family] = models.gbt_predict(trees.model, va)
        test_preds[family] = models.gbt_predict(refits[family], te)
        one = models.feature_importance(trees.model, tr).select(F.lit(family).alias("model"), "*")
        importance = one if importance is None else importance.unionByName(one)
    refit = {"Linear (Ridge)": refit_ridge, **{n: models.TreeModel(m) for n, m in refits.items()}}
    for name, model in refit.items():
        model_store.save_model(spark, out, name, model)
    importance.write.mode("overwrite").parquet(_p(out, "reports", "feature_importance"))
    spark.createDataFrame(stops, "model string, params string, kept int, fitted int, stopped string").write.mode(
        "overwrite").parquet(_p(out, "reports", "boosting_stops"))

    def long(by_model):
        frames = [p.select(F.lit(n).alias("model"), *KEYS, "predicted_sales") for n, p in by_model.items()]
        return durable(reduce(DataFrame.unionByName, frames))

    long_val, long_test = long(val_preds), long(test_preds)
    metrics = durable(rounded(evaluate.evaluate_predictions(va, long_val, by=["model"], with_wmae=True, params=params)))
    gate_row = gate.where(F.col("model") == params.gate_model).select("model", "rmse", "wmae")
    scores = durable(metrics.select("model", "rmse", "wmae").unionByName(gate_row))
    trees = scores.where(F.col("model").isin(*models.GBT_FAMILIES, params.gate_model))
    beating = ensemble.gate_members(scores, params.gate_model)
    two = beating.join(ensemble.top_two(scores, params.gate_model).select("model"), "model", "left_semi")
    two = two.where(two.agg(F.count(F.lit(1))).scalar() >= 2)
    for name, members in (("Ensemble of trees", ensemble.ensemble_members(trees, params.gate_model)), ("Ensemble of the best two", two)):
        made = _ensemble(va, long_val, long_test, durable(members), name, params)
        if made:
            metrics, long_test = metrics.unionByName(made[0]), long_test.unionByName(made[1])
            model_store.save_model(spark, out, made[2], models.EnsembleModel({n: refit[n] for n in made[3]}, made[3]))
    comparison = durable(metrics)
    comparison.write.mode("overwrite").parquet(_p(out, "reports", "model_comparison"))
    sinks.write_predictions(long_test, _p(out, "predictions", "models_test"))
    written = sinks.read_predictions(spark, _p(out, "predictions", "models_test"))
    written.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), F.min("week_date").alias("first_week"),
                                 F.max("week_date").alias("last_week")).write.mode("overwrite").json(_p(out, "reports", "prediction_metadata"))
    test_metrics = rounded(evaluate.evaluate_predictions(te, written, by=["model"], with_wmae=True, params=params))
    best = ensemble.select_best(comparison.select("model", "rmse", "wmae").unionByName(gate_row), params.gate_model)
    (best.join(test_metrics.withColumnsRenamed({c: f"test_{c}" for c in test_metrics.columns if c != "model"}),
               F.col("best_model") == F.col("model")).drop("model")
     .write.mode("overwrite").json(_p(out, "reports", "final_selection")))
    return comparison


def evaluate_stage(spark: SparkSession, out: str, params: Params = DEFAULT) -> DataFrame:
    """Test metrics of every written model, beside its validation metrics (I16), plus the
    holiday segments of the selected model (I13, I19)."""
    f = read_features(spark, out)
    te = f.where(F.col("split") == "test").drop("split")
    preds = sinks.read_predictions(spark, _p(out, "predictions", "models_test"))
    test_metrics = rounded(evaluate.evaluate_predictions(te, preds, by=["model"], with_wmae=True, params=params))
    val_metrics = spark.read.parquet(_p(out, "reports", "model_comparison"))
    report = evaluate.evaluation_report(test_metrics, val_metrics)
    report.write.mode("overwrite").parquet(_p(out, "reports", "evaluation_report"))
    chosen = spark.read.json(_p(out, "reports", "final_selection")).select("best_model").first()[0]
    picked = evaluate.pick_predictions(preds, chosen)
    rounded(evaluate.evaluate_by_segments(te, picked, ["isholiday"], params=params)) \
        .write.mode("overwrite").parquet(_p(out, "reports", "best_model_holiday_segments"))
    return report


def score(spark: SparkSession, out: str, batch: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """The stored model ``name`` (the selected one without) over a batch of feature rows (the test rows
    without), in whatever session: predictions, and refused rows with their reasons, are written."""
    if batch is None:
        f = read_features(spark, out)
        batch = f.where(F.col("split") == "test").drop("split").withColumn("row_id", F.struct(*KEYS))
    name = name or spark.read.json(_p(out, "reports", "final_selection")).select("best_model").first()[0]
    model = model_store.load_model(spark, out, name)
    scored, refused = scoring.score_batch(batch, lambda typed: model.predict(typed, keep=["row_id"]))
    scored.withColumn("model", F.lit(name)).write.mode("overwrite").parquet(_p(out, "predictions", "scored"))
    refused.write.mode("overwrite").parquet(_p(out, "reports", "refused_rows"))
    return spark.read.parquet(_p(out, "predictions", "scored"))


def run(spark: SparkSession, sf_dir: str, out: str, stages=STAGES, params: Params = DEFAULT) -> None:
    for s in stages:
        if s == "etl":
            etl(spark, sf_dir, out, params)
        elif s == "split":
            split(spark, out, params)
        elif s == "features":
            features(spark, out, params)
        elif s == "eda":
            eda_tables(spark, out, params)
        elif s == "baselines":
            baselines(spark, out, params)
        elif s == "train":
            train(spark, out, params)
        elif s == "evaluate":
            evaluate_stage(spark, out, params)
        elif s == "score":
            score(spark, out)
        else:
            raise ValueError(f"unknown stage {s}")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("stages", nargs="*", default=STAGES)
    args = ap.parse_args()
    from tillcast.session import build_session
    spark = build_session()
    run(spark, args.sf, args.out, args.stages or STAGES)


if __name__ == "__main__":
    main()
