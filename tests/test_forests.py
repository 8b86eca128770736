"""A grid of forests scored from its largest one, against Spark's own forests."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from bazaarlens.operators import forests, models
from bazaarlens.operators.features import FEATURES, LABEL, FeatureSpec

GRID = {"maxDepth": [1, 3, 6], "numTrees": [2, 7]}
POINTS = [{"maxDepth": d, "numTrees": n} for d in GRID["maxDepth"] for n in GRID["numTrees"]]


@pytest.fixture(scope="module")
def points(spark):
    """Numbers and a one-hot category, of which the trees split by category."""
    rows = spark.range(900).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("a"), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7))).cast("double").alias("c")
    )
    rows = rows.withColumn(LABEL, F.sin("a") + F.col("c") * F.when(F.col("c") == 3, 4.0).otherwise(0.5))
    rows = OneHotEncoder(inputCols=["c"], outputCols=["hot"]).fit(rows).transform(rows)
    rows = VectorAssembler(inputCols=["a", "hot"], outputCol=FEATURES).transform(rows).select(FEATURES, LABEL)
    return models.laid_out(rows, 2, [LABEL]).cache()


def test_the_largest_point_and_the_first_trees_are_sparks_own(points):
    estimator = models.regressor("random_forest")
    found = dict(zip([tuple(p.values()) for p in POINTS], forests.scores(estimator, POINTS, points, points), strict=True))
    whole = estimator.fit(points, {estimator.numTrees: 7, estimator.maxDepth: 6})
    assert found[6, 7] == pytest.approx(models._r2().evaluate(whole.transform(points)), abs=1e-9)
    rows = points
    for i, tree in enumerate(whole.trees[:2]):
        rows = tree.setFeaturesCol(FEATURES).setPredictionCol(f"p{i}").transform(rows)
    two = rows.withColumn(models.LOG_PREDICTION, (F.col("p0") + F.col("p1")) / 2)
    assert found[6, 2] == pytest.approx(models._r2().evaluate(two), abs=1e-9)


def test_a_cut_tree_is_a_tree_of_that_depth(points):
    """With every feature at every node nothing but the depth differs."""
    estimator = models.regressor("random_forest", featureSubsetStrategy="all", numTrees=7)
    depths = [{"maxDepth": d} for d in (0, 1, 3, 6)]
    own = models._score_grid(estimator, [{estimator.maxDepth: p["maxDepth"]} for p in depths], points, points, 2)
    assert forests.scores(estimator, depths, points, points) == pytest.approx(own, abs=1e-9)


def test_a_fold_takes_one_fit_and_the_best_point_is_fitted_when_asked_for(spark, monkeypatch):
    fits = []
    fit = RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, rows: fits.append((self.getNumTrees(), self.getMaxDepth())) or fit(self, rows))
    spec = FeatureSpec(text="nothing", categories=(), numerics=("x",)).without("nothing")
    rows = spark.range(300).select("id", (F.col("id") % 8).cast("double").alias("x"), F.lit("").alias("nothing"))
    rows = rows.withColumn("price", F.when(F.col("x") < 3, 100.0).otherwise(10000.0))
    tuned = models.tune(rows, "random_forest", spec, keys=("id",), grid=GRID)
    assert tuned.scores == pytest.approx([1.0] * 6) and fits == [(7, 6)] * 3
    assert tuned.model.stages[-1].getNumTrees == 2 and fits[3:] == [(2, 1)]
    assert tuned.model is tuned.model and len(fits) == 4


def test_other_grids_are_fitted_point_by_point():
    forest = models.regressor("random_forest")
    assert forests.from_one(forest, POINTS)
    assert not forests.from_one(forest, [{"maxBins": 10}, {"maxBins": 20}])
    assert not forests.from_one(forest, [{"numTrees": 1}, {"numTrees": 5}])
    assert not forests.from_one(models.regressor("gbt"), [{"maxDepth": 2}])
