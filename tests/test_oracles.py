"""Every SQL-expressible query against its DuckDB oracle on the smallest scale factor,
and every rows-only query at least runs."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.oracle_check import compare

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
# Boosted fits of full length: minutes each, so they run with few rounds here (test_boosting_queries)
SLOW = {"l7_gbt_leaf_wise", "l8_gbt_ordered", "l9_gbt_level_wise", "l10_feature_importance", "l18_gbt_refit_test_metrics"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    r = compare(spark, duck, key, QUERIES[key], ORACLES[key], SMALL)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows_only_query_runs(spark, key):
    rows = QUERIES[key](spark, SMALL).collect()
    assert rows
    if key.startswith(("l11_", "l18_", "l19_")):
        assert all(r["rmse"] > 0 and r["n_samples"] > 0 for r in rows)


@pytest.mark.parametrize("key", sorted(SLOW - {"l8_gbt_ordered"}))
def test_boosting_queries(spark, key, monkeypatch):
    from tillcast.plans import model_plans
    monkeypatch.setattr(model_plans, "QUERY_ROUNDS", 2)
    rows = QUERIES[key](spark, SMALL).collect()
    assert {r["model"] for r in rows} <= set(model_plans.md.GBT_FAMILIES)
    if key.startswith("l10_"):
        assert len(rows) == 3 * len(model_plans.md.MODEL_INPUTS) and all(r["importance"] >= 0 for r in rows)
    else:
        assert all(r["rmse"] > 0 and 1 <= r["n_trees"] <= 2 for r in rows) and len(rows) == (3 if key.startswith("l18_") else 1)
    if key.startswith(("l7_", "l9_")):
        assert rows[0]["stopped"] in ("patience", "rounds") and rows[0]["n_trees"] <= rows[0]["rounds_fitted"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 53
    assert df.count() > 0
