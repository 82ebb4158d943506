"""The end-to-end jobs on files written in the original formats from the driver tables."""

import math

import pytest
from pyspark.sql import functions as F

from encore.operators import batched
from encore.plans import jobs, roles
from encore.sources import write_delimited
from tests.conftest import SF_SMALL


def _song(col):
    return F.concat(F.lit("SO"), F.lpad(F.col(col).cast("string"), 16, "0"))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    roles.error_log_lines(spark, SF_SMALL).write.text(f"{root}/errors")
    roles.accepted_log_lines(spark, SF_SMALL).write.text(f"{root}/accepted")
    inter = roles.base_interactions(spark, SF_SMALL).select(
        F.col("user_id").cast("string").alias("user_id"), _song("song_id").alias("song_id"), "plays")
    write_delimited(inter, f"{root}/triplets", sep="\t", compression="gzip")
    feats = roles.features(spark, SF_SMALL)
    quoted = F.concat(F.lit("'TR"), F.lpad(F.col("track_id").cast("string"), 16, "0"), F.lit("'"))
    feats.select(*[F.col(f"f{i}").cast("string") for i in range(roles.N_FEATURES)], quoted).write.csv(f"{root}/features")
    genres = roles.genre_labels(spark, SF_SMALL).select(
        F.concat(F.lit("TR"), F.lpad(F.col("track_id").cast("string"), 16, "0")), "genre")
    write_delimited(genres, f"{root}/genres", sep="\t")
    return root


def test_cleaning_job(spark, files):
    out = jobs.cleaning_job(spark, f"{files}/errors", f"{files}/accepted", f"{files}/triplets", 30, 650)
    part = roles.table(spark, SF_SMALL, "part").where("p_type = 'PROMO'")
    # Broken lines drop out of both logs: errors of size 50 are never read, and
    # accepted lines of size 1 are rejected, so those stay blocked.
    expected_block = part.where("p_size <> 50 AND NOT (p_size <= 10 AND p_size <> 1)").select(_song("p_partkey").alias("song_id"))
    assert sorted(r[0] for r in out["blocklist"].select("song_id").collect()) == sorted(r[0] for r in expected_block.collect())
    assert out["rejected"].count() == part.where("p_size IN (1, 50)").count()
    inter = spark.read.schema(jobs.TRIPLETS_SCHEMA).option("sep", "\t").csv(f"{files}/triplets")
    assert out["interactions"].count() == inter.join(expected_block, "song_id", "left_anti").count()
    report = out["report"].collect()[0]
    assert report["cleaned_rows"] == out["cleaned"].count() > 0
    assert {r["measure"] for r in out["quantiles"].collect()} == {"items_per_user", "plays_per_item", "users_per_item"}


def test_classification_job(spark, files):
    out = jobs.classification_job(spark, f"{files}/features", f"{files}/genres", positive="es")
    assert out["labelled"].count() == 200
    assert out["labelled"].where("track_id LIKE 'TR%' AND length(track_id) = 18").count() == 200
    n_test = out["logistic_regression_predictions"].count()
    for name in ("logistic_regression", "linear_svm", "random_forest"):
        conf = out[f"{name}_confusion"].collect()[0]
        assert conf["total"] == n_test and conf["tp"] + conf["fp"] + conf["fn"] + conf["tn"] == n_test
        a = out[f"{name}_auc"].collect()[0]["auc"]
        assert a is None or 0.0 <= a <= 1.0
    assert out["correlation"].count() == 64 * 63 // 2


def test_tuning_job(spark, files):
    points = [batched.Point(0.0, 0.0), batched.Point(0.1, 0.5)]
    out = jobs.tuning_job(spark, f"{files}/features", f"{files}/genres", positive="es", folds=3, lr_points=points,
                          svm_grid={"regParam": [0.01, 0.1]}, forest_grid={"numTrees": [5], "maxDepth": [2, 3]})
    chosen = {(r["model"], r["parameter"]): r["value"] for r in out["chosen"].collect()}
    assert chosen["logistic_regression", "regParam"] in (0.0, 0.1) and chosen["random_forest", "maxDepth"] in (2, 3)
    assert all(0 <= chosen[m, "cv_metric"] <= 1 for m in ("logistic_regression", "linear_svm", "random_forest"))
    totals = {out[f"{m}_confusion"].first()["total"] for m in ("logistic_regression", "linear_svm", "random_forest")}
    assert len(totals) == 1 and totals.pop() > 0


def test_multiclass_job(spark, files):
    out = jobs.multiclass_job(spark, f"{files}/features", f"{files}/genres", folds=3, points=[batched.Point(0.0, 0.0), batched.Point(0.01, 0.1)])
    genres = out["genre_index"].count()
    for kind in ("plain", "tuned"):
        rows = out[f"{kind}_predictions"].collect()
        assert rows and {r["prediction"] for r in rows} <= set(map(float, range(genres)))
        assert 0 < out[f"{kind}_scores"].first()["f1"] <= 1
    # Without a penalty both are the same optimum.
    if dict(map(tuple, out["chosen"].collect()))["regParam"] == 0.0:
        both = out["plain_predictions"].join(out["tuned_predictions"].select("track_id", F.col("prediction").alias("tuned")), "track_id")
        assert both.where("prediction <> tuned").count() == 0


def test_recommendation_job(spark, files):
    cleaned = jobs.cleaning_job(spark, f"{files}/errors", f"{files}/accepted", f"{files}/triplets", 30, 650)["cleaned"]
    out = jobs.recommendation_job(spark, cleaned)
    preds = out["predictions"].collect()
    assert preds and not any(math.isnan(r["prediction"]) for r in preds)
    m = out["metrics"].collect()[0]
    assert m["n_users"] > 0 and 0.0 <= m["precision_at_10"] <= 1.0 and 0.0 <= m["ndcg_at_10"] <= 1.0
    assert all(len(r["items"]) <= 10 for r in out["recommended"].collect())
