"""Validation-suite branches the generated data never hits (orphans, duplicates, null keys),
ensemble gate / weights / choice, and EDA edge rules (T6, T8, T15, T18)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillcast.operators import checks, eda, ensemble, segments

FACT = "store_id int, dept_id int, week_date date, weekly_sales decimal(18,2)"


def test_suite_flags_orphans_duplicates_and_null_keys(spark):
    d = dt.date(2010, 2, 5)
    fact = spark.createDataFrame([(1, 1, d, Decimal("5")), (1, 1, d, Decimal("6")), (9, 1, d, Decimal("-1")),
                                  (None, 2, d, Decimal("1"))], FACT)
    stores = spark.createDataFrame([(1, "A", 10)], "store_id int, store_type string, store_size int")
    depts = spark.createDataFrame([(1,), (2,)], "dept_id int")
    res = {r["check"]: r for r in checks.validation_suite(fact, stores, depts, {"dim_store": 45}).collect()}
    assert res["row_count_dim_store"]["passed"] is False and res["row_count_dim_store"]["value"] == "1"
    assert res["null_values"]["passed"] is False
    assert res["duplicate_keys"]["value"] == "1"
    assert res["foreign_keys"]["passed"] is False and res["foreign_keys"]["value"] == "2"
    assert res["negative_values"]["passed"] is True and res["negative_values"]["severity"] == "warning"
    summary = checks.suite_summary(checks.validation_suite(fact, stores, depts)).first()
    assert summary["all_passed"] is False


METRICS = "model string, rmse double, wmae double"


def test_gate_weights_and_choice(spark):
    m = spark.createDataFrame([("gate", 10.0, 10.0), ("a", 5.0, 9.0), ("b", 8.0, 11.0), ("c", 2.0, 1.0)], METRICS)
    members = ensemble.gate_members(m, "gate")
    assert sorted(r["model"] for r in members.collect()) == ["a", "c"]     # b fails WMAE
    w = {r["model"]: r["weight"] for r in ensemble.inverse_rmse_weights(members).collect()}
    assert w["a"] == pytest.approx(0.2 / 0.7) and sum(w.values()) == pytest.approx(1.0)
    assert ensemble.select_best(m, "gate").first()["best_model"] == "c"
    worse = spark.createDataFrame([("gate", 1.0, 1.0), ("a", 5.0, 9.0)], METRICS)
    best = ensemble.select_best(worse, "gate").first()
    assert best["best_model"] == "a" and best["beats_gate"] is False      # nobody beats it: lowest RMSE of the models
    assert ensemble.ensemble_members(m, "gate").count() == 2
    one = spark.createDataFrame([("gate", 10.0, 10.0), ("a", 5.0, 9.0)], METRICS)
    assert ensemble.gate_members(one, "gate").count() == 1 and ensemble.ensemble_members(one, "gate").count() == 0
    assert [r["model"] for r in ensemble.top_two(worse, "gate").collect()] == ["a"]


def test_suite_flags_null_sales_and_a_view_that_lost_rows(spark):
    d = dt.date(2010, 2, 5)
    fact = spark.createDataFrame([(1, 1, d, None), (1, 2, d, Decimal("6"))], FACT)
    stores = spark.createDataFrame([(1, "A", 10)], "store_id int, store_type string, store_size int")
    depts = spark.createDataFrame([(1,), (2,)], "dept_id int")
    res = {r["check"]: r for r in checks.validation_suite(fact, stores, depts, view=fact.limit(1)).collect()}
    assert res["null_values"]["passed"] is False and res["null_values"]["value"] == "1"
    assert res["row_count_view"]["passed"] is False
    assert {r["check"]: r["passed"] for r in checks.validation_suite(fact, stores, depts, view=fact).collect()}["row_count_view"]


def test_every_store_type_has_a_column(spark):
    d = dt.date(2010, 2, 5)
    df = spark.createDataFrame([(d, "A", Decimal("5")), (d, "D", Decimal("6")), (d, None, Decimal("1"))],
                               "week_date date, store_type string, weekly_sales decimal(18,2)")
    r = eda.sales_by_store_type(df).first().asDict()
    assert r == {"week_date": d, "type_A": 5.0, "type_D": 6.0}


def test_skipped_pairs_are_not_samples(spark):
    from tillcast.functions.metrics import metric_columns
    df = spark.createDataFrame([(1.0, 2.0, False), (None, 2.0, False), (3.0, None, True)],
                               "weekly_sales double, predicted_sales double, isholiday boolean")
    assert df.agg(*metric_columns()).first()["n_samples"] == 1


def test_patience_rule():
    from tillcast.operators.models import patience_stop
    assert patience_stop([5, 4, 3, 4, 4, 2], 2) == (3, True)       # stops before the later minimum
    assert patience_stop([5, 4, 3, 4, 2], 3) == (5, False)
    assert patience_stop([1, 1, 1, 1], 3) == (1, True)             # equal is not lower
    assert patience_stop([1], 5) == (1, False)


def test_ensemble_means_need_every_member(spark):
    d = dt.date(2012, 1, 6)
    preds = spark.createDataFrame([("a", 1, 1, d, 10.0), ("c", 1, 1, d, 20.0), ("a", 1, 2, d, 7.0)],
                                  "model string, store_id int, dept_id int, week_date date, predicted_sales double")
    members = spark.createDataFrame([("a", 5.0, 9.0), ("c", 2.0, 1.0)], METRICS)
    s = ensemble.simple_mean(preds, members).collect()
    assert [(r["dept_id"], r["predicted_sales"]) for r in s] == [(1, 15.0)]
    w = ensemble.weighted_mean(preds, members).first()["predicted_sales"]
    assert w == pytest.approx(10 * 0.2 / 0.7 + 20 * 0.5 / 0.7)


def test_volatility_buckets_are_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, -1.0, 0.3, 0.31, 1.0, float("inf"), None]], "cv double")
    got = [r[0] for r in df.select(eda.volatility_bucket(F.col("cv"))).collect()]
    assert got == [None, None, eda.VOLATILITY_LABELS[0], eda.VOLATILITY_LABELS[1], eda.VOLATILITY_LABELS[2],
                   eda.VOLATILITY_LABELS[3], None]


def test_histogram_closes_last_edge(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    h = {r["bin"]: r["count"] for r in eda.histogram(df, "x", 5).collect()}
    # width 2: [0,2) [2,4) [4,6) [6,8) [8,10]; the maximum lands in the last bin, not a sixth
    assert h == {1: 2, 2: 2, 3: 1, 4: 0, 5: 1}


def test_null_series_mean_falls_to_top_quartile_and_zero_total(spark):
    rows = [(1, k, dt.date(2012, 1, 6), Decimal(str(v)) if v is not None else None)
            for k, v in [(1, 10), (2, 20), (3, 30), (4, 40), (5, None)]]
    df = spark.createDataFrame(rows, FACT)
    q = {r["dept_id"]: r["volume_quartile"] for r in segments.volume_quartiles(df).collect()}
    assert q[5] == segments.QUARTILE_LABELS[3] and q[1] == segments.QUARTILE_LABELS[0]
    top = [r["dept_id"] for r in segments.top_departments(df, 10).collect()]
    assert 5 in top                                     # all-null total counts as 0, still ranked


def test_boosting_queries_use_the_full_rounds_and_patience(monkeypatch):
    from tillcast.config import DEFAULT
    from tillcast.plans import model_plans as mp

    class Asked(Exception):
        pass

    def asked(train, val, family, rounds, patience, *rest):
        raise Asked(rounds, patience)

    monkeypatch.setattr(mp, "feature_splits", lambda spark, sf: (None, None, None))
    monkeypatch.setattr(mp.md, "fit_gbt_families", asked)
    for q in (mp._gbt_query("GBT ordered"), mp.q_importance):
        with pytest.raises(Asked) as said:
            q(None, "")
        assert said.value.args == (DEFAULT.boosting_rounds, DEFAULT.boosting_patience) == (1000, 50)
