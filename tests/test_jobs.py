"""The stage jobs end to end on the smallest data, into a scratch folder."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillcast.config import Params
from tillcast.operators import checks
from tillcast.plans import jobs
from tillcast.schemas import FACT
from tillcast.sources import model_store, star_store


def test_stages_end_to_end(spark, tmp_path):
    out = str(tmp_path / "run")
    suite = {r["check"]: r["passed"] for r in jobs.etl(spark, SMALL, out).collect()}
    assert suite["duplicate_keys"] and suite["foreign_keys"] and suite["null_values"] and suite["row_count_view"]
    fact = jobs.star_table(spark, out, "fact")
    n_fact = fact.count()
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT]
    assert star_store.staged(spark, out, "fact_stg").count() == 0              # staging cleared
    jobs.etl(spark, SMALL, out)                                                  # re-run: upsert, no growth
    assert jobs.star_version(spark, out) == 2 and jobs.star_table(spark, out, "fact").count() == n_fact
    jobs.split(spark, out)
    assert spark.sql("SELECT COUNT(*) FROM vw_sales_analytics").first()[0] == n_fact
    jobs.features(spark, out)
    assert len(jobs.read_features(spark, out).columns) == 53
    jobs.eda_tables(spark, out)
    jobs.baselines(spark, out)
    assert spark.read.parquet(f"{out}/reports/baseline_results").count() == 5
    comparison = jobs.train(spark, out, Params(boosting_rounds=3, boosting_patience=2))
    rows = {r["model"]: r for r in comparison.collect()}
    assert 4 <= len(rows) <= 6                                   # ridge, 3 tree families, ensembles of two or more
    n_val = jobs.read_features(spark, out).where(F.col("split") == "val").count()
    assert all(r["n_samples"] == n_val for r in rows.values())                  # predictions join back by key
    report = jobs.evaluate_stage(spark, out)
    assert report.count() == len(rows) and "val_rmse" in report.columns
    record = spark.read.json(f"{out}/reports/final_selection").first()
    assert record["best_model"] in rows and record["test_rmse"] > 0
    assert spark.read.json(f"{out}/reports/prediction_metadata").count() == len(rows)
    assert spark.read.parquet(f"{out}/reports/feature_importance").select("model").distinct().count() == 3
    assert {r["stopped"] for r in spark.read.parquet(f"{out}/reports/boosting_stops").collect()} <= {"patience", "rounds"}
    # every model is stored and scores as it did when it was fitted
    written = spark.read.parquet(f"{out}/predictions/models_test")
    te = jobs.read_features(spark, out).where("split = 'test'").drop("split")
    assert set(model_store.stored_models(spark, out).values()) == {1} and len(model_store.stored_models(spark, out)) == len(rows)
    for name in rows:
        loaded = model_store.load_model(spark, out, name).predict(te).withColumnRenamed("predicted_sales", "again")
        both = written.where(F.col("model") == name).join(loaded, ["store_id", "dept_id", "week_date"])
        worst = both.agg(F.count(F.lit(1)), F.max(F.abs(F.col("again") - F.col("predicted_sales")))).first()
        assert worst[0] == te.count() and worst[1] < 1e-4, (name, worst)
    scored = jobs.score(spark, out)
    assert scored.count() == te.count() and scored.first()["model"] == record["best_model"]
    assert spark.read.parquet(f"{out}/reports/refused_rows").count() == 0
    with pytest.raises(LookupError):
        model_store.load_model(spark, out, "never fitted")


def staged_fact(spark):
    return jobs.ingest.ingest(*jobs.raw_from_view(jobs.fixtures.analytics_view(spark, SMALL)))[2]


def files(out):
    return {str(p.relative_to(out)) for p in pathlib.Path(out, "star", "fact").rglob("*.parquet")}


def test_a_failing_job_leaves_the_published_tables(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "run")
    jobs.etl(spark, SMALL, out)
    before = jobs.star_table(spark, out, "fact").count()

    def broken(*a, **k):
        raise OSError("passing read error")

    staged = staged_fact(spark)
    star_store.stage(staged.limit(3), out, "fact_stg", "a")
    with monkeypatch.context() as m:
        m.setattr(jobs, "star_table", broken)                    # the target cannot be read
        with pytest.raises(OSError):
            jobs.merge_staging(spark, out)
    assert jobs.star_version(spark, out) == 1 and jobs.star_table(spark, out, "fact").count() == before
    # staged values that the fact cannot hold, and duplicate keys, stop the job before publishing
    bad = staged.limit(1).withColumn("cpi", F.lit(5000.0))
    star_store.clear_staging(spark, out)
    star_store.stage(bad, out, "fact_stg", "a")
    with pytest.raises(ValueError, match="cannot hold"):
        jobs.merge_staging(spark, out)
    star_store.clear_staging(spark, out)
    for batch in "ab":                                           # one row in two batches
        star_store.stage(staged.orderBy("store_id", "dept_id", "week_date").limit(1), out, "fact_stg", batch)
    with pytest.raises(ValueError, match="duplicate"):
        jobs.merge_staging(spark, out)
    assert jobs.star_version(spark, out) == 1 and jobs.star_table(spark, out, "fact").count() == before


def test_a_load_after_a_failed_one_publishes(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "run")
    with monkeypatch.context() as m:
        m.setattr(jobs.checks, "suite_summary", lambda r: r.selectExpr("false AS all_passed"))
        with pytest.raises(ValueError, match="not published"):
            jobs.etl(spark, SMALL, out)
    assert jobs.star_version(spark, out) == 0 and star_store.staged(spark, out, "fact_stg").count() > 0
    jobs.etl(spark, SMALL, out)
    assert jobs.star_version(spark, out) == 2
    assert jobs.star_table(spark, out, "fact").count() == staged_fact(spark).count()


def test_a_week_rewrites_its_month_alone(spark, tmp_path):
    out = str(tmp_path / "run")
    jobs.etl(spark, SMALL, out)
    first, rows = files(out), {tuple(r)[:3]: r.weekly_sales for r in jobs.star_table(spark, out, "fact").collect()}
    week = dt.date(1998, 3, 6)
    new = staged_fact(spark).where(F.col("week_date") == F.lit(week)).withColumn("weekly_sales", F.lit(7.25)).withColumn("cpi", F.lit(None))
    for _ in range(2):                                           # the same batch staged twice counts once
        star_store.stage(new, out, "fact_stg", "week")
    star_store.stage(spark.createDataFrame([(99, "Z", 5)], "store_id int, store_type string, store_size int"), out, "dim_store_stg", "week")
    star_store.stage(spark.createDataFrame([(77,)], "dept_id int"), out, "dim_dept_stg", "week")
    results = {r["check"]: r for r in jobs.merge_staging(spark, out).collect()}
    written = files(out) - first
    assert first <= files(out) and written and all("load=000002/month=1998-03/" in f for f in written)
    after = {tuple(r)[:3]: (r.weekly_sales, r.cpi) for r in jobs.star_table(spark, out, "fact").collect()}
    assert set(after) == set(rows) and int(results["row_count_fact"]["value"]) == len(rows)
    assert all(float(v) == 7.25 and c is None for k, (v, c) in after.items() if k[2] == week)
    assert all(after[k][0] == v for k, v in rows.items() if k[2] != week)
    assert jobs.star_table(spark, out, "fact", 1).count() == len(rows)                  # the version before stands
    assert {r.store_id for r in jobs.star_table(spark, out, "dim_store").collect()} >= {1, 99}
    # what the manifest adds up to is what a check of the whole fact finds
    whole = jobs.checks.validation_suite(*(jobs.star_table(spark, out, n) for n in ("fact", "dim_store", "dim_dept")))
    assert {r["check"]: r["value"] for r in whole.collect()}.items() <= {k: r["value"] for k, r in results.items()}.items()
    # one month is read from its folder alone
    march = star_store.read_fact(spark, out, 2, ["1998-03"])
    assert {"load=000002" in f and "month=1998-03" in f for f in march.inputFiles()} == {True}


def test_two_loads_at_once_have_their_own_versions(spark, tmp_path):
    out = str(tmp_path / "run")
    a, b = star_store.claim(spark, out), star_store.claim(spark, out)
    assert (a, b) == (1, 2)
    star_store.publish(spark, out, b, 0)
    with pytest.raises(ValueError, match="was published"):
        star_store.publish(spark, out, a, 0)
    assert jobs.star_version(spark, out) == 2


def test_the_new_fact_is_scanned_once(spark, tmp_path):
    fact = spark.createDataFrame([(1, 1, dt.date(2010, 2, 5), 5.0)], "store_id int, dept_id int, week_date date, weekly_sales double")
    fact.write.parquet(f"{tmp_path}/fact")
    dims = [spark.createDataFrame([(1,)], f"{c} int") for c in ("store_id", "dept_id")]
    profile = checks.fact_profile(spark.read.parquet(f"{tmp_path}/fact"), *dims)
    assert profile._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert profile.first()["n_rows"] == 1


def feature_rows(df):
    return sorted(map(str, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


def test_features_of_appended_weeks_equal_a_rebuild(spark, tmp_path):
    out = str(tmp_path / "run")
    raw = staged_fact(spark)
    weeks = sorted(r[0] for r in raw.select("week_date").distinct().collect())
    jobs.star_store.clear_staging(spark, out)
    jobs.stage_raw(spark, out, jobs.raw_from_view(jobs.fixtures.analytics_view(spark, SMALL)), "all")
    # a series that begins with the new weeks, and one that has ended before them
    early = raw.where((F.col("week_date") < F.lit(weeks[-4])) & ~((F.col("store_id") == 1) & (F.col("dept_id") == 1)))
    star_store.stage(early, out, "fact_stg", "all")
    jobs.merge_staging(spark, out)
    jobs.split(spark, out)
    jobs.features(spark, out)
    assert jobs.append_features(spark, out) == 0                                    # nothing new
    late = raw.where((F.col("week_date") >= F.lit(weeks[-4])) & (F.col("dept_id") != 2))
    star_store.stage(late, out, "fact_stg", "weeks")
    jobs.merge_staging(spark, out)
    changed = jobs.changed_rows(spark, out, 1)
    assert {f.split("month=")[1][:7] for f in changed.inputFiles() if "month=" in f} <= {str(w)[:7] for w in weeks[-4:]}
    before = {str(p) for p in pathlib.Path(out, "features").rglob("*.parquet")}
    n = jobs.append_features(spark, out)
    assert 0 < n <= 2 * late.count()
    kept = before & {str(p) for p in pathlib.Path(out, "features").rglob("*.parquet")}
    assert len(kept) > len(before) / 2                                               # old months were not written
    appended = feature_rows(jobs.read_features(spark, out))
    tail = feature_rows(spark.read.parquet(f"{out}/feature_state/tail"))
    jobs.split(spark, out)
    jobs.features(spark, out)
    assert appended == feature_rows(jobs.read_features(spark, out))
    assert tail == feature_rows(spark.read.parquet(f"{out}/feature_state/tail"))
    # a restated old week makes a rebuild
    star_store.stage(raw.where(F.col("week_date") == F.lit(weeks[10])).withColumn("weekly_sales", F.lit(3.5)), out, "fact_stg", "old")
    jobs.merge_staging(spark, out)
    assert jobs.append_features(spark, out) == -1
    rebuilt = jobs.read_features(spark, out).where((F.col("week_date") == F.lit(weeks[10])) & (F.col("dept_id") > 2))
    assert {r.weekly_sales for r in rebuilt.collect()} == {3.5}
