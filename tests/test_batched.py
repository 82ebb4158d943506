"""Batched grid fits against separate fits, and forests as tables."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from encore.operators import batched, certify, evaluate, forests, models


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 4)) * [1, 30, 0.1, 1] + [0, 100, 0, 0]
    x[:, 3] = 2.5  # a constant feature
    z = 0.8 * x[:, 0] - 0.03 * (x[:, 1] - 100) + rng.normal(size=900)
    rows = [(i, *map(float, r), int(v > 0.3), int(np.digitize(v, [-0.8, 0.8]))) for i, (r, v) in enumerate(zip(x, z, strict=True))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, label int, kind int").repartition(5)
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).cache()


POINTS = [batched.Point(r, a) for r in (0.0, 0.02, 0.2) for a in (0.0, 0.5, 1.0)]


@pytest.mark.parametrize("kind", ["binary", "multinomial"])
def test_grid_agrees_with_separate_fits(data, kind):
    binary = kind == "binary"
    train = data if binary else data.withColumn("label", F.col("kind"))
    tuned = batched.tune_logistic(train, POINTS, models.fold_of(["id"], 3), 3, "auc" if binary else "f1")
    est = models.logistic(family=kind if not binary else "binomial", tol=1e-10, maxIter=300)
    grid = [{est.regParam: p.reg, est.elasticNetParam: p.alpha} for p in POINTS]
    evaluator = models.binary_evaluator() if binary else models.multiclass_evaluator("f1")
    told = models.tune(est, grid, evaluator, train, folds=3, keys=["id"])
    assert np.allclose(tuned.scores, told.avgMetrics, atol=2e-4 if binary else 3e-3)
    assert told.avgMetrics[tuned.best] >= max(told.avgMetrics) - 2e-4 - (0 if binary else 3e-3)
    model = est.copy(grid[tuned.best]).fit(train)
    matrix = model.coefficientMatrix.toArray()
    got = tuned.coefficients - (0 if binary or POINTS[tuned.best].reg else tuned.coefficients.mean(axis=0) - matrix.mean(axis=0))
    assert np.allclose(got, matrix, atol=2e-3 * max(1, np.abs(matrix).max()))
    assert not certify.tuned_certificate(tuned, train).where("violated").count()
    predicted = batched.predict(train, tuned).join(model.transform(train).select("id", F.col("prediction").alias("told")), "id")
    assert predicted.where("prediction <> told").count() <= 3
    off = tuned._replace(intercepts=tuned.intercepts + np.arange(1, 1 + len(tuned.intercepts)) * 0.01)
    assert certify.tuned_certificate(off, train).where("violated").count()


def test_all_grid_points_are_optimal(data):
    for point in POINTS:
        tuned = batched.tune_logistic(data, [point], models.fold_of(["id"], 2), 2)
        assert not certify.tuned_certificate(tuned, data).where("violated").count(), point
        if point.alpha == 1.0 and point.reg == 0.2:
            assert (tuned.coefficients == 0).sum() >= 2  # the absolute part clears coefficients
    with pytest.raises(ValueError):
        batched.tune_logistic(data.where("id < 0"), POINTS[:1], models.fold_of(["id"], 2), 2)


def test_grouped_auc(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), int(h), float(rng.integers(0, 30)), int(rng.random() < 0.4)) for g in range(3) for h in range(2) for _ in range(80)] + [(9, 9, 1.0, 1)]
    df = spark.createDataFrame(rows, "g int, h int, score double, label int")
    found = {(r["g"], r["h"]): r["auc"] for r in evaluate.grouped_auc(df, ["g", "h"]).collect()}
    for (g, h), a in found.items():
        own = evaluate.auc(df.where(f"g = {g} AND h = {h}")).first()["auc"]
        assert a is None and own is None if (g, h) == (9, 9) else a == pytest.approx(own, abs=1e-12)
    assert len(found) == 7


def test_forest_as_a_table(spark, data, tmp_dir, monkeypatch):
    model = models.forest(numTrees=7, maxDepth=4).fit(data)
    nodes = forests.forest_nodes(spark, model, f"{tmp_dir}/forest")
    assert nodes.count() == model.totalNumNodes
    rows = data.select("id", vector_to_array("features").alias("x"))
    for bound in (10**6, 1):  # sent to the tasks, and joined by a shuffle
        monkeypatch.setattr(forests, "BROADCAST_NODES", bound)
        routed = forests.route(rows, nodes, "id", "x", 7, 4)
        votes = {r["id"]: r for r in forests.forest_votes(routed, "id", 2).collect()}
        for r in model.transform(data).collect():
            assert votes[r["id"]]["prediction"] == r["prediction"] and np.allclose(votes[r["id"]]["probability"], r["probability"].toArray())
        counted = {(r["tree"], r["node"]): r["n"] for r in forests.populations(routed).collect()}
        inner = nodes.where("left IS NOT NULL").collect()
        assert all(counted[t, 0] == 900 for t in range(7))
        assert all(counted.get((r["tree"], r["node"]), 0) == counted.get((r["tree"], r["left"]), 0) + counted.get((r["tree"], r["right"]), 0) for r in inner)
