"""Properties: percentiles equal numpy on random input, no lag reads a later row,
split sizes add up, valid + rejected rows equal the batch."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from tillcast.functions.quantiles import exact_percentiles
from tillcast.operators import checks

FAST = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@FAST
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60), st.floats(0, 1))
def test_percentile_equals_numpy(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_percentiles(df, "x", [q]).first()["value"]
    assert got == pytest.approx(float(np.quantile(np.array(values, dtype=float), q)), abs=1e-9)


@pytest.fixture(scope="module")
def feats(spark):
    return entry.queries()["l1_build_features"](spark, SMALL).cache()


def test_lags_never_read_later_rows(feats):
    from pyspark.sql import Window
    w = Window.partitionBy("store_id", "dept_id").orderBy("week_date")
    prev = feats.withColumn("_prev", F.lag("weekly_sales", 1).over(w))
    bad = prev.where(~F.col("lag_1").eqNullSafe(F.col("_prev"))).count()
    assert bad == 0
    # a rolling mean never exceeds the max of the rows before it
    m = feats.withColumn("_mx", F.max("weekly_sales").over(w.rowsBetween(-4, -1)))
    assert m.where(F.col("rolling_mean_4") > F.col("_mx") + 1e-9).count() == 0


def test_split_sizes_add_up(spark, feats):
    total = entry.queries()["a11_analytics_view"](spark, SMALL).count()
    parts = {r["split"]: r["count"] for r in feats.groupBy("split").count().collect()}
    assert sum(parts.values()) == total and set(parts) <= {"train", "val", "test"}


def test_valid_plus_rejected_is_the_batch(feats):
    batch = feats.withColumn("week_of_year", F.when(F.col("dept_id") == 3, F.lit(0)).otherwise(F.col("week_of_year")))
    valid, rejected = checks.apply_contract(batch)
    assert valid.count() + rejected.count() == batch.count()
    assert rejected.count() == batch.where(F.col("dept_id") == 3).count()
