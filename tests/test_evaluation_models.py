import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.operators import evaluate, features, models


def test_confusion_without_true_positive(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0), (0, 1.0)], "label int, prediction double")
    r = evaluate.confusion_metrics(df).collect()[0]
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["total"]) == (0, 1, 1, 1, 3)
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["accuracy"] == pytest.approx(1 / 3)
    empty = evaluate.confusion_metrics(df.limit(0)).collect()[0]
    assert empty["total"] == 0 and empty["accuracy"] is None


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(3)
    # "+ 0.0" turns -0.0 into 0.0: SQL grouping treats them as one score, the RDD evaluator does not.
    rows = [(int(y), float(round(s, 1)) + 0.0) for y, s in zip(rng.integers(0, 2, 800), rng.normal(size=800))]
    df = spark.createDataFrame(rows, "label int, score double")
    ours = evaluate.auc(df, "score", "label", partitions=4).collect()[0]["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ours == pytest.approx(brute, abs=1e-12)
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(ref, abs=1e-12)


def test_multiclass_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(float(i % 5), float((i % 5 + (1 if i % 3 == 0 else 0)) % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = evaluate.multiclass_scores(df).collect()[0]
    for metric, col in (("f1", "f1"), ("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                        ("weightedRecall", "weighted_recall")):
        assert ours[col] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df), abs=1e-12)


def test_scaler_is_x_over_sample_stddev_and_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], "x double, z double")
    model = features.feature_pipeline(["x", "z"], k=None, output="s").fit(df)
    out = features.vector_columns(model.transform(df).select("x", "s"), "s", ["sx", "sz"]).orderBy("x").collect()
    assert [r["sx"] for r in out] == pytest.approx([v / 1.5275252316519468 for v in (1.0, 2.0, 4.0)])
    assert [r["sz"] for r in out] == [0.0, 0.0, 0.0]


def test_null_in_assembled_column_raises(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 2.0)], "x double, y double")
    with pytest.raises(Exception):
        features.feature_pipeline(["x", "y"], k=None).fit(df).transform(df).collect()


def test_pca_matches_numpy_up_to_sign(spark):
    rng = np.random.default_rng(11)
    data = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double, d double")
    model = features.feature_pipeline(["a", "b", "c", "d"], k=2).fit(df)
    got = np.array([r["features"].toArray() for r in model.transform(df).collect()])
    scaled = data / data.std(axis=0, ddof=1)
    cov = np.cov(scaled, rowvar=False)
    vals, vecs = np.linalg.eigh(cov)
    top = vecs[:, np.argsort(vals)[::-1][:2]]
    want = scaled @ top
    for j in range(2):
        assert np.allclose(np.abs(got[:, j]), np.abs(want[:, j]), atol=1e-8)


def _separable(spark):
    rows = [(float(i % 2), float(i % 2) * 3 + (i % 7) * 0.1, float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "label double, a double, b double")
    return features.feature_pipeline(["a", "b"], k=None).fit(df).transform(df).select("label", "features")


def test_classifiers_learn_separable_data_and_keep_rows(spark):
    df = _separable(spark)
    for est in (models.logistic(), models.svm(), models.forest(numTrees=5)):
        pred = models.fit(est, df).transform(df)
        r = evaluate.confusion_metrics(pred).collect()[0]
        assert r["total"] == 120 and r["tp"] + r["fp"] + r["fn"] + r["tn"] == 120
        assert r["accuracy"] > 0.95


def test_cross_validation_seeded_and_deterministic(spark):
    df = _separable(spark)
    lr = models.logistic()
    g = models.grid(lr, regParam=[0.0, 0.1])
    a = models.tune(lr, g, models.binary_evaluator(), df, folds=3, seed=5)
    b = models.tune(lr, g, models.binary_evaluator(), df, folds=3, seed=5)
    assert a.avgMetrics == b.avgMetrics and len(a.avgMetrics) == 2
    chosen = models.chosen_params(a)
    assert chosen["regParam"] in (0.0, 0.1) and chosen["cv_metric"] == max(a.avgMetrics)


def test_cross_validation_over_whole_pipeline(spark):
    """Scaling is re-fitted inside every fold when the pipeline is the estimator."""
    from pyspark.ml import Pipeline

    rows = [(float(i % 2), float(i % 2) * 3 + (i % 7) * 0.1, float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "label double, a double, b double")
    prep = features.feature_pipeline(["a", "b"], k=None)
    lr = models.logistic()
    whole = Pipeline(stages=prep.getStages() + [lr])
    cv = models.tune(whole, models.grid(lr, regParam=[0.0, 0.1]), models.binary_evaluator(), df, folds=3)
    assert cv.transform(df).count() == 120


def test_als_seeded_no_nan_with_drop(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 3]
    df = spark.createDataFrame(rows, "u int, i int, r double")
    test = spark.createDataFrame([(0, 1, 1.0), (1, 99, 2.0)], "u int, i int, r double")  # item 99 unseen
    m1 = models.als("u", "i", "r", seed=3).fit(df)
    m2 = models.als("u", "i", "r", seed=3).fit(df.repartition(5))
    p1 = m1.transform(test).collect()
    assert len(p1) == 1 and not np.isnan(p1[0]["prediction"])
    assert p1[0]["prediction"] == pytest.approx(m2.transform(test).collect()[0]["prediction"], abs=1e-5)
    nan_mode = models.als("u", "i", "r", seed=3, cold_start="nan").fit(df).transform(test).collect()
    assert len(nan_mode) == 2
