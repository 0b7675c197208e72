"""Boosting that goes on: rounds add up, patience ends it, the model is Spark's own and can be stored."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillcast.operators import baselines as bl
from tillcast.operators import evaluate as ev
from tillcast.operators import models as md
from tillcast.plans.feature_plans import shared_features
from tillcast.schemas import KEYS
from tillcast.session import durable

PARAMS = dict(maxDepth=3, stepSize=0.2)


@pytest.fixture(scope="module")
def curve(spark):
    """A noisy curve: fitted rows and held ones."""
    rows = spark.range(1200).select((F.col("id") / 100).alias("x"), F.pmod(F.xxhash64("id"), F.lit(7)).cast("double").alias("z"), "id")
    rows = rows.withColumn(md.TARGET, F.sin("x") * 10 + F.col("z") + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100)) / 25)
    rows = durable(VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows))
    return rows.where("id % 3 > 0"), rows.where("id % 3 = 0")


def test_eight_rounds_and_eight_more_equal_sixteen(curve, monkeypatch):
    rows, held = curve
    monkeypatch.setattr(md, "STATE_ROUNDS", 5)
    parts, whole = (md.Boosting(rows, PARAMS, 32, 5, held) for _ in range(2))
    parts.advance(8)
    parts.advance(8)
    whole.advance(16)
    assert len(parts.trees) == len(whole.errors) == 16
    assert parts.errors == pytest.approx(whole.errors, rel=1e-12)
    model = whole.model(16)
    assert model.getNumTrees == 16 and model.treeWeights[:2] == [1.0, 0.2]
    error = RegressionEvaluator(labelCol=md.TARGET, metricName="mse").evaluate(model.transform(held))
    assert error == pytest.approx(whole.errors[-1], rel=1e-9)                     # the state is what the model predicts
    cut = RegressionEvaluator(labelCol=md.TARGET, metricName="mse").evaluate(whole.model(11).transform(held))
    assert cut == pytest.approx(whole.errors[10], rel=1e-9)
    importance = model.featureImportances.toArray()
    assert importance.sum() == pytest.approx(1) and importance[0] > importance[1] > 0


def test_errors_are_those_of_sparks_own_boosting(curve):
    rows, held = curve
    mine = md.Boosting(rows, PARAMS, 32, 5, held)
    mine.advance(6)
    # Spark fits twice the residual (the gradient of the squared error), so its step counts double
    spark_model = GBTRegressor(featuresCol="features", labelCol=md.TARGET, maxIter=6, maxBins=32, seed=5, maxDepth=3, stepSize=0.1).fit(rows)
    theirs = spark_model.evaluateEachIteration(held, "squared")
    assert mine.errors == pytest.approx(theirs, rel=1e-6)


def test_patience_stops_at_the_lowest_error(curve, monkeypatch):
    rows, held = curve
    monkeypatch.setattr(md, "STATE_ROUNDS", 4)
    deep = md.Boosting(rows, dict(maxDepth=8, stepSize=1.0), 32, 5, held)         # overfits at once
    kept, why = deep.until(200, 4)
    assert why == "patience" and len(deep.trees) < 60
    assert deep.errors[kept - 1] == min(deep.errors[:kept + 4])
    slow = md.Boosting(rows, dict(maxDepth=1, stepSize=0.01), 32, 5, held)
    assert slow.until(4, 6) == (4, "rounds")


def test_trees_of_the_features_and_their_store(spark, tmp_path):
    from tillcast.sources.model_store import load_model, save_model
    f = shared_features(spark, SMALL)
    train, val = (durable(f.where(F.col("split") == s).drop("split")) for s in ("train", "val"))
    fitted = md.fit_gbt_families(train, val, ["GBT ordered"], 3, 2)["GBT ordered"]
    assert len(fitted.log) == 3 and fitted.trees <= 3 and all(grown <= 3 for _, _, grown, _ in fitted.log)
    preds = md.gbt_predict(fitted.model, val)
    m = ev.evaluate_predictions(val, preds, with_wmae=True).first()
    assert m["rmse"] == pytest.approx(fitted.rmse, rel=1e-6)
    mean = train.agg(F.avg("weekly_sales")).first()[0]
    naive = val.agg(F.sqrt(F.avg((F.col("weekly_sales") - mean) ** 2))).first()[0]
    assert m["rmse"] < naive
    save_model(spark, str(tmp_path), "trees", md.TreeModel(fitted.model))
    again = load_model(spark, str(tmp_path), "trees").predict(val).withColumnRenamed("predicted_sales", "again")
    assert preds.join(again, KEYS).where(F.abs(F.col("again") - F.col("predicted_sales")) > 1e-9).count() == 0
    assert bl.SEASONAL_NAIVE                                                    # the gate that the trees are held against
    kinds = {a["name"] for a in fitted.model.transform(md.tree_frame(val)).schema["features"].metadata["ml_attr"]["attrs"].get("nominal", [])}
    assert kinds == {"store_type_index", "dept_id_index"}


def test_fits_of_a_grid_share_their_jobs(spark, curve):
    rows, held = curve
    grid = [PARAMS, dict(maxDepth=2, stepSize=0.1), dict(maxDepth=3, stepSize=0.1, subsamplingRate=0.7)]
    fits = md.BoostedGrid(rows, grid, 32, 5, held)
    spark.sparkContext.setJobGroup("boosting", "four rounds of three fits")
    try:
        fits.grow([4, 4, 4])
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosting"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs <= 4 * 3 + 3                                                    # a level each, then the state and the errors
    for point, params in zip(fits.points, grid):
        alone = md.Boosting(rows, params, 32, 5, held)
        alone.advance(4)
        assert alone.errors == pytest.approx(point.errors, rel=1e-12)


def test_categories_and_shuffled_sums_give_sparks_own_trees(spark, monkeypatch):
    from pyspark.ml.feature import StringIndexer

    rows = spark.range(900).select((F.col("id") % 90 / 7).alias("x"), F.pmod(F.xxhash64("id"), F.lit(11)).cast("string").alias("kind"), "id")
    rows = rows.withColumn(md.TARGET, F.pmod(F.crc32("kind"), F.lit(17)) + F.col("x") + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)) / 50)
    rows = StringIndexer(inputCol="kind", outputCol="k").fit(rows).transform(rows)
    rows = durable(VectorAssembler(inputCols=["x", "k"], outputCol="features").transform(rows))
    theirs = GBTRegressor(featuresCol="features", labelCol=md.TARGET, maxIter=3, maxBins=32, seed=5, maxDepth=4, stepSize=0.1).fit(rows)
    for most in (md.tg.DRIVER_BYTES, 1):                                        # summed by the driver, in a shuffle
        monkeypatch.setattr(md.tg, "DRIVER_BYTES", most)
        mine = md.Boosting(rows, dict(maxDepth=4, stepSize=0.2), 32, 5, rows)
        mine.advance(3)
        model = mine.model(3)
        both = model.transform(rows).withColumnRenamed("prediction", "mine").join(theirs.transform(rows).select("id", "prediction"), "id")
        assert both.where(F.abs(F.col("mine") - F.col("prediction")) > 1e-9).count() == 0
        assert [t.numNodes for t in model.trees] == [t.numNodes for t in theirs.trees]
        first, expected = model.trees[0].featureImportances.toArray(), theirs.trees[0].featureImportances.toArray()
        assert first == pytest.approx(expected, rel=1e-9)
        assert model.trees[0]._java_obj.rootNode().impurity() == pytest.approx(theirs.trees[0]._java_obj.rootNode().impurity())
    assert "kind" in rows.columns and mine.grid.bins.nominal == [False, True]


def test_no_training_rows_is_an_error(curve):
    with pytest.raises(ValueError, match="training rows"):
        md.Boosting(curve[0].limit(0), PARAMS, 32, 5)
