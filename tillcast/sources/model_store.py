"""Saved models (L18, L20, L21): fitted once, scored from in any later session.

Every model has a folder of versions.  A ridge is three small tables (inputs with their median,
scale and weight; category levels; the fit), trees are a Spark ML pipeline, an ensemble is the table of
its members' names, versions and weights."""

from __future__ import annotations

import os
import re

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tillcast.operators.models import EnsembleModel, LinearPrep, RidgeModel, TreeModel
from tillcast.sources import versions

CARD = "name string, kind string, features int"


def root(out: str, name: str) -> str:
    return os.path.join(out, "models", re.sub(r"[^A-Za-z0-9_-]+", "_", name).strip("_"))


def save_model(spark: SparkSession, out: str, name: str, model) -> int:
    """Write ``model`` as the next version under ``name`` and publish it; the version."""
    at = root(out, name)
    version = versions.claim(spark, at)

    def table(rows, schema, part):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(versions.folder(at, version, part))

    if isinstance(model, RidgeModel):
        prep = model.prep
        table([(i, c, float(prep.medians[c]), *map(float, prep.scale[c]), float(w)) for i, (c, w) in enumerate(zip(prep.columns, model.coef))],
              "at int, input string, median double, mean double, std double, weight double", "inputs")
        table([(c, i, str(v), type(v).__name__) for c, levels in prep.levels.items() for i, v in enumerate(levels)],
              "category string, at int, level string, type string", "levels")
        table([(float(model.alpha), float(model.intercept), [float(s) for s in model.cv_scores])],
              "alpha double, intercept double, cv_scores array<double>", "fit")
    elif isinstance(model, TreeModel):
        model.pipeline.write().overwrite().save(versions.folder(at, version, "pipeline"))
    elif isinstance(model, EnsembleModel):
        table([(n, versions.newest(spark, root(out, n)), float(w)) for n, w in model.weights.items()],
              "model string, version int, weight double", "members")
    else:
        raise TypeError(f"no way to store a {type(model).__name__}")
    table([(name, type(model).__name__, len(model.inputs))], CARD, "card")
    versions.publish(spark, at, version)
    return version


def load_model(spark: SparkSession, out: str, name: str, version: int | None = None):
    """The newest published version of ``name``, or the one asked for."""
    at = root(out, name)
    version = versions.newest(spark, at) if version is None else version
    if not version:
        raise LookupError(f"no model {name!r} is stored")

    def table(part):
        return spark.read.parquet(versions.folder(at, version, part))

    kind = table("card").first()["kind"]
    if kind == TreeModel.__name__:
        return TreeModel(PipelineModel.load(versions.folder(at, version, "pipeline")))
    if kind == EnsembleModel.__name__:
        rows = table("members").orderBy("model").collect()
        return EnsembleModel({r["model"]: load_model(spark, out, r["model"], r["version"]) for r in rows},
                             {r["model"]: r["weight"] for r in rows})
    inputs, levels = table("inputs").orderBy("at").collect(), {}        # a row an input, a row a level
    for r in table("levels").orderBy("category", "at").collect():
        levels.setdefault(r["category"], []).append(int(r["level"]) if r["type"] == "int" else r["level"])
    prep = LinearPrep(levels, [r["input"] for r in inputs], {r["input"]: r["median"] for r in inputs},
                      {r["input"]: (r["mean"], r["std"]) for r in inputs})
    fit = table("fit").first()
    return RidgeModel(prep, fit["alpha"], fit["intercept"], np.array([r["weight"] for r in inputs]), list(fit["cv_scores"]))


def stored_models(spark: SparkSession, out: str) -> dict[str, int]:
    """Folder names of the stored models, with their newest published versions."""
    top = os.path.join(out, "models")
    found = {n: versions.newest(spark, os.path.join(top, n)) for n in versions.children(spark, top)}
    return {n: v for n, v in found.items() if v}
