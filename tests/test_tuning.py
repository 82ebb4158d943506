"""Cross-validation of separate fits: few tasks however finely the rows are dealt out, same models."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler

from encore.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3))
    made = [(i, *map(float, r), int(r[0] - 0.5 * r[1] + rng.normal() > 0)) for i, r in enumerate(x)]
    df = spark.createDataFrame(made, "id int, a double, b double, c double, label int")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.fixture()
def dealt(monkeypatch):
    """The partitions of every frame that a cross-validation gets."""
    seen, fit = [], models.CrossValidator.fit

    def noted(self, dataset, *args):
        seen.append(dataset.rdd.getNumPartitions())
        return fit(self, dataset, *args)

    monkeypatch.setattr(models.CrossValidator, "fit", noted)
    return seen


def _svm(train):
    est = models.svm()
    return models.tune(est, models.grid(est, regParam=[0.01, 0.1]), models.binary_evaluator(), train, folds=2, keys=["id"])


def test_svm_grid_on_finely_dealt_rows(rows, dealt, monkeypatch):
    fine, one = _svm(rows.repartition(64, "id")), _svm(rows.coalesce(1))
    assert dealt == [1, 1]
    assert np.allclose(fine.avgMetrics, one.avgMetrics, atol=1e-6)
    assert np.allclose(fine.bestModel.coefficients, one.bestModel.coefficients, atol=1e-6)
    monkeypatch.setattr(models, "TUNE_ROWS", 150)
    _svm(rows.repartition(64, "id"))
    assert dealt[2:] == [3]  # more rows, more tasks


def test_forest_grid_on_finely_dealt_rows(rows, dealt):
    est = models.forest()
    grid = models.grid(est, numTrees=[3, 5], maxDepth=[2])
    found = models.tune(est, grid, models.binary_evaluator(), rows.repartition(64, "id"), folds=2, keys=["id"], parallelism=1)
    assert dealt == [1]
    assert found.bestModel.getNumTrees in (3, 5) and min(found.avgMetrics) > 0.6


def test_trees_become_objects_when_asked_for(rows, monkeypatch):
    made, init = [], DecisionTreeClassificationModel.__init__

    def noted(self, *args):
        made.append(self)
        init(self, *args)

    monkeypatch.setattr(DecisionTreeClassificationModel, "__init__", noted)
    est = models.forest()
    found = models.tune(est, models.grid(est, numTrees=[3, 5], maxDepth=[2]), models.binary_evaluator(), rows, folds=2, keys=["id"])
    got = found.transform(rows).select("id", "probability", "prediction").orderBy("id").collect()
    assert not made
    best = found.bestModel
    depths = [t.depth for t in best.trees]
    assert len(depths) == len(made) == best.getNumTrees
    plain = RandomForestClassifier(featuresCol="features", labelCol="label", seed=models.SEED, numTrees=best.getNumTrees, maxDepth=2)
    own = plain.fit(rows.coalesce(1))  # the forest of Spark's own estimator
    told = own.transform(rows).select("id", "probability", "prediction").orderBy("id").collect()
    assert got == told and depths == [t.depth for t in own.trees]


def test_empty_train_is_an_error(rows):
    with pytest.raises(Exception, match="(?i)empty"):
        _svm(rows.where("id < 0"))
