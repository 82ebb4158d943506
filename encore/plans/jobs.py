"""The three end-to-end jobs, on files in their original formats.

A user of the original scripts points these at the same inputs:

* :func:`cleaning_job` -- correction logs (text) and interaction triplets
  (tab-separated, gzip or plain) -> block list, cleaned interactions, profiles;
* :func:`classification_job` -- a headerless feature CSV (quoted ids in the
  last column) and a genre TSV -> labelled features, model predictions and scores;
* :func:`tuning_job` -- the same files -> cross-validated logistic regression, linear SVM and
  random forest, their chosen parameters and scores;
* :func:`multiclass_job` -- the same files -> a plain and a tuned multinomial model of all
  genres and their scores;
* :func:`recommendation_job` -- cleaned interactions -> ALS predictions on a
  hold-out and ranking metrics of the re-ranked hold-out.

Each returns a dict of lazy DataFrames except where a model must be fitted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions import columns as C
from encore.operators import activity, batched, evaluate, features, indexing, joins, models, physical, profile, ranking
from encore.operators import sampling
from encore.plans.catalog import FOREST_GRID, LR_POINTS, MULTICLASS_POINTS, SVM_GRID
from encore.sources import delimited, logs

# Schemas and default parameters of the original jobs.
TRIPLETS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("song_id", T.StringType(), True),
    T.StructField("plays", T.IntegerType(), True),
])
GENRE_SCHEMA = T.StructType([
    T.StructField("track_id", T.StringType(), True),
    T.StructField("genre", T.StringType(), True),
])
MIN_ITEMS_PER_USER = 15
MIN_PLAYS_PER_ITEM = 10
POSITIVE_GENRE = "Electronic"
TOP_N = 10


def cleaning_job(
    spark: SparkSession,
    errors_log: str,
    accepted_log: str,
    triplets: str,
    min_items: int = MIN_ITEMS_PER_USER,
    min_plays: int = MIN_PLAYS_PER_ITEM,
) -> dict[str, DataFrame]:
    """Parse both logs, build the block list, remove blocked songs from the
    triplets, profile users and songs and keep active users on popular songs."""
    errors, errors_rejected = logs.parse_correction_log(logs.read_log_lines(spark, errors_log), logs.ERROR_PREFIX)
    accepted, accepted_rejected = logs.parse_correction_log(
        logs.read_log_lines(spark, accepted_log), logs.ACCEPTED_PREFIX
    )
    block = joins.blocklist(errors, accepted, "song_id")
    # One task reads a gzip file whole, so its rows are dealt out over the cores.
    raw = physical.spread(delimited.read_delimited(spark, triplets, TRIPLETS_SCHEMA, sep="\t"))
    kept = physical.materialize(
        joins.exclude(raw, block, "song_id", broadcast_rows=joins.DEFAULT_BROADCAST_ROWS,
                      hot_rows=joins.HOT_KEY_ROWS), "triplets"
    )
    users = activity.user_activity(kept)
    items = activity.item_activity(kept)
    return {
        "errors": errors,
        "accepted": accepted,
        "rejected": errors_rejected.select(F.lit("errors").alias("log"), "value").unionByName(
            accepted_rejected.select(F.lit("accepted").alias("log"), "value")),
        "blocklist": block,
        "interactions": kept,
        "user_activity": users,
        "item_activity": items,
        "item_popularity": activity.item_popularity(kept),
        "activity_profile": profile.profile(users, ["song_count", "play_count"]).unionByName(
            profile.profile(activity.item_popularity(kept), ["user_count", "sum_play_count"])),
        "quantiles": profile.exact_quantiles_stacked(
            [("items_per_user", users, "song_count"), ("plays_per_item", items, "play_count"),
             ("users_per_item", items, "user_count")]),
        "cleaned": activity.clean_interactions(kept, min_items, min_plays),
        "report": activity.retention_report(kept, min_items, min_plays),
    }


def read_untyped_features(spark: SparkSession, path: str) -> DataFrame:
    """Headerless feature CSV: every column but the last cast to double, the
    last renamed ``track_id`` and stripped of its quote wrapper."""
    raw = delimited.read_delimited(spark, path, schema=None)
    typed = C.rename_at(C.cast_columns(raw, raw.columns[:-1], "double"), -1, "track_id")
    return typed.withColumn("track_id", C.unquote_id("track_id"))


def classification_job(
    spark: SparkSession,
    features_path: str,
    genres_path: str,
    positive: str = POSITIVE_GENRE,
    resample: bool = True,
    pca_k: int = 5,
    seed: int = models.SEED,
) -> dict[str, DataFrame]:
    """Binary genre classification: label join, 80/20 split, optional class
    re-balancing of the training part, scale + PCA fitted on training only,
    logistic regression / linear SVM / random forest, scores per model."""
    feats, labelled, cols = _labelled(spark, features_path, genres_path, positive)
    train, train_f, test_f = _binary_parts(labelled, cols, resample, pca_k, seed)
    out: dict[str, DataFrame] = {
        "labelled": labelled,
        "correlation": profile.correlation(feats, cols),
        "class_balance": profile.class_balance(labelled, "label"),
        "train_balance": profile.class_balance(train, "label"),
    }
    estimators = {"logistic_regression": (models.logistic(), "probability"),
                  "linear_svm": (models.svm(), "rawPrediction"),
                  "random_forest": (models.forest(seed=seed), "probability")}
    for name, (est, score_col) in estimators.items():
        out |= _judged(name, _scored(models.fit(est, train_f).transform(test_f), score_col))
    return out


def _labelled(spark: SparkSession, features_path: str, genres_path: str, positive: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The features, the features with genre and binary label, and the numeric columns."""
    feats = read_untyped_features(spark, features_path)
    genres = delimited.read_delimited(spark, genres_path, GENRE_SCHEMA, sep="\t")
    labelled = joins.attach_labels(feats, genres, "track_id").withColumn("label", C.binary_label("genre", positive))
    return feats, labelled, C.numeric_columns(labelled, exclude=["label"])


def _binary_parts(labelled: DataFrame, cols: list[str], resample: bool, pca_k: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The training rows, and training and test rows with features fitted on the former."""
    train, test = sampling.hash_split(labelled, ["track_id"], [0.8, 0.2], salt=str(seed))
    if resample:
        train = sampling.stratified_sample(train, "label", {0: 0.1, 1: 1.0}, ["track_id"], salt=f"sample{seed}")
    keep = ["track_id", "genre", "features", "label"]
    _, (train_f, test_f) = features.fit_transform(features.feature_pipeline(cols, k=pca_k), train, test, keep=keep)
    return train, train_f, test_f


def _scored(predictions: DataFrame, score_col: str) -> DataFrame:
    return predictions.select("track_id", "label", "prediction", vector_to_array(F.col(score_col))[1].alias("score"))


def _judged(name: str, pred: DataFrame) -> dict[str, DataFrame]:
    return {f"{name}_predictions": pred, f"{name}_confusion": evaluate.confusion_metrics(pred), f"{name}_auc": evaluate.auc(pred, "score", "label")}


def tuning_job(
    spark: SparkSession,
    features_path: str,
    genres_path: str,
    positive: str = POSITIVE_GENRE,
    resample: bool = True,
    pca_k: int = 5,
    seed: int = models.SEED,
    folds: int = 5,
    lr_points: Sequence[batched.Point] = LR_POINTS,
    svm_grid: Mapping[str, Sequence] = SVM_GRID,
    forest_grid: Mapping[str, Sequence] = FOREST_GRID,
) -> dict[str, DataFrame]:
    """Cross-validation of the three classifiers on the same training rows, folds by a hash of
    the track id: predictions, confusion tables and AUC of the chosen models on the test rows,
    and ``chosen`` (model, parameter, value) with the mean validation score. All logistic
    models are fitted together, one scan per iteration."""
    _, labelled, cols = _labelled(spark, features_path, genres_path, positive)
    _, train_f, test_f = _binary_parts(labelled, cols, resample, pca_k, seed)
    train, test = physical.materialize(train_f, "tuning-train"), physical.materialize(test_f, "tuning-test")
    tuned = batched.tune_logistic(train, lr_points, models.fold_of(["track_id"], folds, seed), folds)
    point = tuned.points[tuned.best]
    chosen = [("logistic_regression", k, float(v)) for k, v in (("regParam", point.reg), ("elasticNetParam", point.alpha), ("cv_metric", tuned.scores[tuned.best]))]
    out = _judged("logistic_regression", batched.predict(test, tuned).select("track_id", "label", "prediction", "score"))
    for name, est, grid, score_col in (("linear_svm", models.svm(), svm_grid, "rawPrediction"), ("random_forest", models.forest(seed=seed), forest_grid, "probability")):
        best = models.tune(est, models.grid(est, **grid), models.binary_evaluator(), train, folds=folds, seed=seed, keys=["track_id"])
        out |= _judged(name, _scored(best.transform(test), score_col))
        chosen += [(name, k, float(v)) for k, v in models.chosen_params(best).items()]
    return out | {"chosen": spark.createDataFrame(chosen, "model string, parameter string, value double")}


def multiclass_job(
    spark: SparkSession,
    features_path: str,
    genres_path: str,
    pca_k: int = 5,
    seed: int = models.SEED,
    folds: int = 5,
    points: Sequence[batched.Point] = MULTICLASS_POINTS,
) -> dict[str, DataFrame]:
    """All genres: labels by frequency, 80/20 split, a plain multinomial model and one tuned by
    weighted F1; predictions and scores of both on the test rows, and ``chosen``."""
    _, labelled, cols = _labelled(spark, features_path, genres_path, POSITIVE_GENRE)
    genres = indexing.index_values(labelled, "genre", "index")
    indexed = indexing.apply_index(labelled.drop("label"), genres, "genre", "label", broadcast_rows=joins.DEFAULT_BROADCAST_ROWS)
    train, test = sampling.hash_split(indexed, ["track_id"], [0.8, 0.2], salt=str(seed))
    keep = ["track_id", "genre", "features", "label"]
    _, parts = features.fit_transform(features.feature_pipeline(cols, k=pca_k), train, test, keep=keep)
    train_f, test_f = (physical.materialize(part, "multiclass") for part in parts)
    plain = models.fit(models.logistic(family="multinomial"), train_f).transform(test_f).select("track_id", "genre", "label", "prediction")
    tuned = batched.tune_logistic(train_f, points, models.fold_of(["track_id"], folds, seed), folds, "f1")
    best = batched.predict(test_f, tuned).select("track_id", "genre", "label", "prediction")
    point = tuned.points[tuned.best]
    chosen = [("regParam", point.reg), ("elasticNetParam", point.alpha), ("cv_metric", tuned.scores[tuned.best])]
    return {
        "genre_index": genres,
        "plain_predictions": plain, "plain_scores": evaluate.multiclass_scores(plain),
        "tuned_predictions": best, "tuned_scores": evaluate.multiclass_scores(best),
        "chosen": spark.createDataFrame([(k, float(v)) for k, v in chosen], "parameter string, value double"),
    }


def recommendation_job(
    spark: SparkSession,
    cleaned: DataFrame,
    n: int = TOP_N,
    ks: tuple[int, ...] = (5, 10),
    seed: int = models.SEED,
) -> dict[str, DataFrame]:
    """Integer ids by frequency, 70/30 split by row, ALS (iterations 5,
    regularisation 0.01), predictions for the hold-out, then the hold-out of
    every user re-ranked by the model and scored against the user's most
    played hold-out songs."""
    base = physical.materialize(cleaned.withColumn("_row", F.monotonically_increasing_id()), "cleaned")
    users = indexing.index_values(base, "user_id", "index")
    items = indexing.index_values(base, "song_id", "index")
    bound = joins.DEFAULT_BROADCAST_ROWS
    enc = indexing.apply_index(base, users, "user_id", "user_index", broadcast_rows=bound)
    enc = indexing.apply_index(enc, items, "song_id", "item_index", broadcast_rows=bound)
    enc = enc.withColumn("user_index", F.col("user_index").cast("int")).withColumn(
        "item_index", F.col("item_index").cast("int"))
    train, test = sampling.hash_split(enc, ["_row"], [0.7, 0.3], salt=str(seed))
    blocks = max(10, physical.default_parallelism(spark))
    model = models.als("user_index", "item_index", "plays", seed=seed, blocks=blocks).fit(train)
    pred = model.transform(test)
    rec = ranking.top_n(pred, "user_id", "prediction", n, ties="break", tie_break=["song_id"], rank_col="position")
    rel = ranking.top_n(test, "user_id", "plays", n, ties="keep")
    return {
        "cold_start_users": joins.cold_start(test, train, "user_id"),
        "cold_start_items": joins.cold_start(test, train, "song_id"),
        "predictions": pred.drop("_row"),
        "recommended": ranking.ranked_lists(pred, "user_id", "song_id", "prediction", n),
        "metrics": ranking.ranking_metrics(rec, rel, "user_id", "song_id", "position", ks),
    }
