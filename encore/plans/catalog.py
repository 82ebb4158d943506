"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query wires roles (``encore.plans.roles``) into operators. SQL
equivalents for the DuckDB oracle live in ``encore.plans.oracles`` under the
same keys; computed columns carry the same aliases there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions import columns as C
from encore.operators import activity, batched, certify, evaluate, forests, indexing, joins, models, physical, profile, ranking, sampling, sketches
from encore.operators import features as feat
from encore.plans import roles
from encore.session import scratch_path
from encore.sources import attributes as attrs
from encore.sources import counts, delimited, logs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Split weights, class fractions and tuning grids of the
# reference's jobs.
TRAIN_TEST = [0.8, 0.2]
HOLDOUT = [0.7, 0.3]
# Coverage checks train on a thin part, so that some users and items are really cold.
THIN_TRAIN = [0.05, 0.95]
DOWNSAMPLE = {0: 0.1, 1: 1.0}
PCA_K = 5
LR_GRID = {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.1, 0.5]}
SVM_GRID = {"regParam": [0.0, 0.01, 0.1]}
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [2, 4], "maxBins": [16, 32]}
MULTICLASS_GRID = {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.1, 0.2]}
LR_POINTS, MULTICLASS_POINTS = (
    [batched.Point(reg, alpha) for reg in g["regParam"] for alpha in g["elasticNetParam"]] for g in (LR_GRID, MULTICLASS_GRID))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.blocklist(roles.error_records(spark, sf_dir), roles.accepted_records(spark, sf_dir), "song_id")


def _without_blocked(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Interactions minus the block list. The block list is a filtered
    dimension table, so an explicit bounded count decides its broadcast."""
    base = roles.interactions(spark, sf_dir) if keyed else roles.base_interactions(spark, sf_dir)
    return joins.exclude(base, _blocklist(spark, sf_dir), "song_id",
                         broadcast_rows=joins.DEFAULT_BROADCAST_ROWS, hot_rows=joins.HOT_KEY_ROWS)


def _shared_base(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """The same, written once to shared storage for plans that read it in
    several branches (the role mapping behind it is a join of the two largest
    tables, too costly to repeat per branch)."""
    return physical.materialize(_without_blocked(spark, sf_dir, keyed), "interactions")


# --- cleaning chain -------------------------------------------------------


@query
def blocklist(spark, sf_dir):
    return _blocklist(spark, sf_dir)


@query
def anti_blocked(spark, sf_dir):
    return _without_blocked(spark, sf_dir)


@query
def user_activity(spark, sf_dir):
    return activity.user_activity(_without_blocked(spark, sf_dir))


@query
def item_activity(spark, sf_dir):
    return activity.item_activity(_without_blocked(spark, sf_dir))


@query
def item_popularity(spark, sf_dir):
    return activity.item_popularity(_without_blocked(spark, sf_dir))


@query
def top_items(spark, sf_dir):
    pop = activity.item_popularity(_without_blocked(spark, sf_dir))
    return activity.top_k(pop, "user_count", 20, "song_id")


@query
def distinct_counts(spark, sf_dir):
    return activity.distinct_counts(_without_blocked(spark, sf_dir))


@query
def active_users(spark, sf_dir):
    return activity.active_users(_without_blocked(spark, sf_dir), roles.MIN_ITEMS_PER_USER)


@query
def popular_items(spark, sf_dir):
    return activity.popular_items(_without_blocked(spark, sf_dir), roles.MIN_PLAYS_PER_ITEM)


@query
def clean_interactions(spark, sf_dir):
    return activity.clean_interactions(
        _shared_base(spark, sf_dir), roles.MIN_ITEMS_PER_USER, roles.MIN_PLAYS_PER_ITEM
    )


@query
def retention_report(spark, sf_dir):
    return activity.retention_report(
        _shared_base(spark, sf_dir), roles.MIN_ITEMS_PER_USER, roles.MIN_PLAYS_PER_ITEM
    )


# --- sources ----------------------------------------------------------------


DRIVER_TABLES = roles.TABLE_NAMES


@query
def parse_log(spark, sf_dir):
    parsed, _ = logs.parse_correction_log(roles.error_log_lines(spark, sf_dir), logs.ERROR_PREFIX)
    return parsed


@query
def parse_accepted_log(spark, sf_dir):
    parsed, _ = logs.parse_correction_log(roles.accepted_log_lines(spark, sf_dir), logs.ACCEPTED_PREFIX)
    return parsed


@query
def rejected_lines(spark, sf_dir):
    _, bad_errors = logs.parse_correction_log(roles.error_log_lines(spark, sf_dir), logs.ERROR_PREFIX)
    _, bad_accepted = logs.parse_correction_log(roles.accepted_log_lines(spark, sf_dir), logs.ACCEPTED_PREFIX)
    return bad_errors.select(F.lit("errors").alias("log"), "value").unionByName(
        bad_accepted.select(F.lit("accepted").alias("log"), "value")
    )


@query
def scan_delimited(spark, sf_dir):
    """Interactions written as gzip TSV and read back with a fixed schema."""
    path = scratch_path(spark, "interactions-tsv")
    delimited.write_delimited(roles.base_interactions(spark, sf_dir), path, sep="\t", compression="gzip")
    return delimited.read_delimited(spark, path, "user_id string, song_id string, plays int", sep="\t")


def _feature_set_files(spark, sf_dir) -> str:
    """Write the feature role as headerless CSV plus its attribute file."""
    feats = roles.features(spark, sf_dir)
    names = feats.columns[:-1]
    root = scratch_path(spark, "feature-set")
    # Attribute rows: one per column of the written table (bounded by its width).
    rows = [(c, "NUMERIC" if i % 2 == 0 else "real") for i, c in enumerate(names)] + [("TRACK_ID", "string")]
    spark.createDataFrame(rows, attrs.ATTRIBUTE_SCHEMA).coalesce(1).write.csv(f"{root}/attributes")
    feats.select(*names, F.col("track_id").cast("string")).write.csv(f"{root}/features")
    return root


@query
def schema_from_attributes(spark, sf_dir):
    root = _feature_set_files(spark, sf_dir)
    return attrs.read_feature_set(spark, f"{root}/attributes", f"{root}/features")


@query
def attribute_types(spark, sf_dir):
    """Every column of the given tables typed by its values; the attribute rows written, read back and counted."""
    found = _stacked([attrs.column_types(roles.table(spark, sf_dir, name)) for name in DRIVER_TABLES])
    path = scratch_path(spark, "attributes")
    found.write.csv(path)
    return attrs.attribute_types(attrs.read_attributes(spark, path))


@query
def spread_scan(spark, sf_dir):
    """A gzip scan (one task a file) dealt out over all cores by user."""
    return physical.spread(scan_delimited(spark, sf_dir), "user_id")


POPULARITY = "song_id bigint, user_count bigint, sum_play_count bigint"


def _ordered_popularity(spark, sf_dir):
    path = scratch_path(spark, "popularity-csv")
    popularity = activity.item_popularity(_without_blocked(spark, sf_dir))
    manifest = physical.materialize(delimited.write_ordered(popularity, path, [F.col("user_count").desc(), "song_id"]), "manifest")
    return manifest, delimited.read_ordered(spark, path, manifest, POPULARITY)


@query
def ordered_export(spark, sf_dir):
    """The item popularity written in order by many tasks; read back with each row's place in the whole."""
    return _ordered_popularity(spark, sf_dir)[1]


@query
def single_file_report(spark, sf_dir):
    """What one file of the ordered item popularity would hold: the manifest's rows, the last place, and the sums of the rows read back."""
    manifest, rows = _ordered_popularity(spark, sf_dir)
    sums = rows.agg(F.max("row_no").alias("last_row"), F.sum("user_count").alias("user_count"), F.sum("sum_play_count").alias("play_count"))
    # One row each.
    return manifest.agg(F.sum("n_rows").alias("n_items")).join(sums, F.col("n_items") == F.col("last_row")).drop("last_row")


@query
def row_counts(spark, sf_dir):
    return counts.row_counts({name: roles.table(spark, sf_dir, name) for name in DRIVER_TABLES})


@query
def log_line_counts(spark, sf_dir):
    """Both logs written as text files, read back, lines counted per file and
    summed per log (the per-directory line counts of the shell step)."""
    root = scratch_path(spark, "logs")
    roles.error_log_lines(spark, sf_dir).write.text(f"{root}/errors")
    roles.accepted_log_lines(spark, sf_dir).write.text(f"{root}/accepted")
    per_file = counts.line_counts(logs.read_log_lines(spark, [f"{root}/errors", f"{root}/accepted"]))
    log = F.regexp_extract("file", r"/(errors|accepted)/[^/]*$", 1)
    return per_file.groupBy(log.alias("log")).agg(F.sum("n_lines").alias("n_lines"))


def _untyped_features(spark, sf_dir):
    """Features as text without a schema; ids wrapped in single quotes."""
    feats = roles.features(spark, sf_dir)
    names = feats.columns[:-1]
    path = scratch_path(spark, "features-untyped")
    quoted = F.concat(F.lit("'TR"), F.lpad(F.col("track_id").cast("string"), 16, "0"), F.lit("'"))
    feats.select(*[F.col(c).cast("string") for c in names], quoted.alias("id")).write.csv(path)
    return delimited.read_delimited(spark, path, schema=None)


@query
def cast_features(spark, sf_dir):
    raw = _untyped_features(spark, sf_dir)
    typed = C.cast_columns(raw, raw.columns[:-1], "double")
    return C.rename_at(typed, -1, "track_id")


@query
def unquote_id(spark, sf_dir):
    df = cast_features(spark, sf_dir)
    return df.withColumn("track_id", C.unquote_id("track_id"))


# --- labels and classes ------------------------------------------------------


def _features_labels(spark, sf_dir):
    return joins.attach_labels(roles.features(spark, sf_dir), roles.genre_labels(spark, sf_dir), "track_id")


def _binary(spark, sf_dir):
    return _features_labels(spark, sf_dir).withColumn("label", C.binary_label("genre", roles.POSITIVE_GENRE))


@query
def features_labels(spark, sf_dir):
    return _features_labels(spark, sf_dir)


@query
def binary_label(spark, sf_dir):
    return _binary(spark, sf_dir).select("track_id", "genre", "label")


@query
def class_balance(spark, sf_dir):
    return profile.class_balance(_binary(spark, sf_dir), "label", "genre")


# --- statistics ----------------------------------------------------------------

STAT_DIGITS = 9
FEATURES = [f"f{i}" for i in range(roles.N_FEATURES)]


def _rounded_profile(df, cols):
    p = profile.profile(df, cols)
    return p.select("column", "count", F.round("mean", STAT_DIGITS).alias("mean"),
                    F.round("stddev", STAT_DIGITS).alias("stddev"), "min", "max")


@query
def profile_features(spark, sf_dir):
    return _rounded_profile(roles.features(spark, sf_dir), FEATURES)


@query
def profile_activity(spark, sf_dir):
    base = _shared_base(spark, sf_dir)
    users = _rounded_profile(activity.user_activity(base), ["song_count", "play_count"])
    items = _rounded_profile(activity.item_popularity(base), ["user_count", "sum_play_count"])
    return users.unionByName(items)


def _measures(spark, sf_dir):
    base = _shared_base(spark, sf_dir)
    users = activity.user_activity(base)
    items = activity.item_activity(base)
    return [("items_per_user", users, "song_count"), ("plays_per_item", items, "play_count"),
            ("users_per_item", items, "user_count")]


@query
def quantiles_exact(spark, sf_dir):
    return profile.exact_quantiles_stacked(_measures(spark, sf_dir))


@query
def quantiles_approx(spark, sf_dir):
    """Each approximate quantile with the exact quantiles ``REL_ERR`` below and above it,
    between which the sketch must stay."""
    measures = _measures(spark, sf_dir)
    approx = profile.approx_quantiles_checked(measures, rel_err=REL_ERR).select("measure", "prob", "value")
    sides = [(p, round(max(p - REL_ERR, 0.0), 9), round(min(p + REL_ERR, 1.0), 9)) for p in profile.DEFAULT_PROBS]
    exact = profile.exact_quantiles_stacked(measures, sorted({q for _, low, high in sides for q in (low, high)}))
    # One row per measure and probability.
    bounds = exact.groupBy("measure").agg(
        *[F.max(F.when(F.col("prob") == q, F.col("value"))).alias(f"{side}{i}")
          for i, (_, low, high) in enumerate(sides) for side, q in (("lower", low), ("upper", high))])
    cells = [F.struct(F.lit(p).alias("prob"), F.col(f"lower{i}").alias("lower"), F.col(f"upper{i}").alias("upper"))
             for i, (p, _, _) in enumerate(sides)]
    bounds = bounds.select("measure", F.explode(F.array(*cells)).alias("b")).select("measure", "b.*")
    return approx.join(bounds, ["measure", "prob"]).select(
        "measure", "prob", "lower", "upper", F.col("value").between(F.col("lower"), F.col("upper")).alias("within_bound"))


REL_ERR = 0.05
CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty2_tax"]


def _corr(spark, sf_dir):
    li = roles.table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    li = li.withColumn("qty2_tax", F.col("l_quantity") * 2 + F.col("l_tax"))
    r = profile.correlation(li, CORR_COLUMNS)
    return r.select("feature_x", "feature_y", F.round("r", STAT_DIGITS).alias("r"))


@query
def correlation_pairs(spark, sf_dir):
    return _corr(spark, sf_dir)


@query
def correlated_pairs(spark, sf_dir):
    return profile.correlated_pairs(_corr(spark, sf_dir), 0.9)


@query
def correlation_features(spark, sf_dir):
    """All pairs of all features, from one scan."""
    r = profile.correlation(roles.features(spark, sf_dir), FEATURES)
    return r.select("feature_x", "feature_y", F.round("r", STAT_DIGITS).alias("r"))


@query
def quantile_sketches(spark, sf_dir):
    """Event values sketched by type and day, the stored sketches merged by type, and the
    ranks of the merged quantiles counted among the rows."""
    events = roles.table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    stored = sketches.stored_sketches(events, "value", ["event_type", "day"], scratch_path(spark, "sketches"))
    merged = sketches.merged_quantiles(stored, profile.DEFAULT_PROBS, ["event_type"])
    days = stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_sketches"))
    checked = sketches.rank_bounds(events, "value", merged, "event_type")
    return checked.join(days, "event_type").select("event_type", "prob", "n", "n_sketches", "within_bound")


# --- splits, sampling, indexing ----------------------------------------------------


def _keyed_without_blocked(spark, sf_dir):
    return _without_blocked(spark, sf_dir, keyed=True)


def _keyed_clean(spark, sf_dir):
    return activity.clean_interactions(
        _shared_base(spark, sf_dir, keyed=True), roles.MIN_ITEMS_PER_USER, roles.MIN_PLAYS_PER_ITEM
    )


@query
def hash_split(spark, sf_dir):
    df = _keyed_without_blocked(spark, sf_dir)
    return df.withColumn("split", sampling.split_label(["row_key"], HOLDOUT, ["train", "test"]))


@query
def stratified_sample(spark, sf_dir):
    df = _binary(spark, sf_dir)
    train, _ = sampling.hash_split(df, ["track_id"], TRAIN_TEST)
    sample = sampling.stratified_sample(train, "label", DOWNSAMPLE, ["track_id"], salt="sample")
    return sample.select("track_id", "genre", "label")


@query
def split_class_counts(spark, sf_dir):
    """Rows per class in the training part, the test part and the re-balanced training part."""
    df = _binary(spark, sf_dir).select("track_id", "genre", "label")
    train, test = sampling.hash_split(df, ["track_id"], TRAIN_TEST)
    sample = sampling.stratified_sample(train, "label", DOWNSAMPLE, ["track_id"], salt="sample")
    parts = [part.withColumn("part", F.lit(name)) for name, part in (("train", train), ("test", test), ("sample", sample))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("part", "label", "genre").agg(F.count(F.lit(1)).alias("n_rows"))


def _shared_clean(spark, sf_dir):
    """Cleaned interactions written once for plans that read them in several
    branches (each recomputation would repeat two semi joins)."""
    return physical.materialize(_keyed_clean(spark, sf_dir), "clean")


def _thin_split(spark, sf_dir):
    return sampling.hash_split(_shared_clean(spark, sf_dir), ["row_key"], THIN_TRAIN)


@query
def cold_start_users(spark, sf_dir):
    train, test = _thin_split(spark, sf_dir)
    return joins.cold_start(test, train, "user_id")


@query
def cold_start_items(spark, sf_dir):
    train, test = _thin_split(spark, sf_dir)
    return joins.cold_start(test, train, "song_id")


@query
def string_index(spark, sf_dir):
    return indexing.index_values(roles.table(spark, sf_dir, "documents"), "lang", "index")


@query
def user_index(spark, sf_dir):
    return indexing.index_values(_keyed_clean(spark, sf_dir), "user_id", "index")


# --- ranking ---------------------------------------------------------------------

N = roles.TOP_N
METRIC_DIGITS = 9


def _shared_pairs(spark, sf_dir):
    """Scored pairs (a join and an aggregate of the two largest tables) written
    once for plans that read them in two branches."""
    return physical.materialize(roles.scored_pairs(spark, sf_dir), "pairs")


def _recommended(pairs):
    return ranking.top_n(pairs, "user_id", "prediction", N, ties="break", tie_break=["song_id"], rank_col="position")


def _relevant(pairs):
    return ranking.top_n(pairs, "user_id", "plays", N, ties="keep")


@query
def topn_per_user(spark, sf_dir):
    return ranking.top_n(_shared_pairs(spark, sf_dir), "user_id", "prediction", N, ties="keep")


@query
def relevant_per_user(spark, sf_dir):
    return _relevant(_shared_pairs(spark, sf_dir))


@query
def ranked_lists(spark, sf_dir):
    lists = ranking.ranked_lists(roles.scored_pairs(spark, sf_dir), "user_id", "song_id", "prediction", N)
    return lists.select("user_id", F.concat_ws(",", F.transform("items", lambda x: x.cast("string"))).alias("items"))


@query
def ranked_pairs(spark, sf_dir):
    pairs = _shared_pairs(spark, sf_dir)
    rec = _recommended(pairs).select("user_id", "song_id", "position")
    rel = _relevant(pairs).select("user_id", "song_id", "rank")
    both = rec.select("user_id").distinct().join(rel.select("user_id").distinct(), "user_id")
    joined = rec.join(rel, ["user_id", "song_id"], "full_outer")
    # `both` is partitioned by user already; a user with many tied relevant
    # rows is kept out of that shuffle join.
    return joins.keep_matching(joined, both, "user_id", hot_rows=joins.HOT_KEY_ROWS)


@query
def predictions_sorted(spark, sf_dir):
    pairs = roles.scored_pairs(spark, sf_dir)
    return pairs.orderBy(F.col("user_id"), F.col("song_id"), F.col("prediction").desc())


def _metrics(spark, sf_dir):
    pairs = _shared_pairs(spark, sf_dir)
    m = ranking.ranking_metrics(_recommended(pairs), _relevant(pairs), "user_id", "song_id", "position", (5, 10))
    return m.select("n_users", *[F.round(c, METRIC_DIGITS).alias(c) for c in m.columns if c != "n_users"])


@query
def ranking_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query
def precision_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select("precision_at_5", "precision_at_10")


@query
def map_score(spark, sf_dir):
    return _metrics(spark, sf_dir).select("mean_average_precision")


@query
def ndcg_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select("ndcg_at_5", "ndcg_at_10")


# --- evaluation on fixed scores ---------------------------------------------------------


@query
def confusion_matrix(spark, sf_dir):
    m = evaluate.confusion_metrics(roles.binary_scores(spark, sf_dir))
    return m.select(*[F.round(c, METRIC_DIGITS).alias(c) if c in ("accuracy", "recall", "precision") else c
                      for c in m.columns])


@query
def auc(spark, sf_dir):
    a = evaluate.auc(roles.binary_scores(spark, sf_dir), "score", "label")
    return a.select(F.round("auc", METRIC_DIGITS).alias("auc"), "n_positive", "n_negative")


@query
def multiclass_scores(spark, sf_dir):
    m = evaluate.multiclass_scores(roles.multiclass_scores_input(spark, sf_dir))
    return m.select(*[F.round(c, METRIC_DIGITS).alias(c) for c in m.columns])


# --- features and models (Spark ML) ---------------------------------------------------------


PREDICTION_COLS = ["track_id", "genre", "label", "prediction", "score"]


@query
def assemble_scale(spark, sf_dir):
    df = roles.features(spark, sf_dir)
    cols = C.numeric_columns(df, exclude=["track_id"])
    model = feat.feature_pipeline(cols, k=None, output="scaled").fit(df)
    out = feat.vector_columns(model.transform(df).select("track_id", "scaled"), "scaled", [f"s{i}" for i in range(len(cols))])
    return out.select("track_id", *[F.round(f"s{i}", STAT_DIGITS).alias(f"s{i}") for i in range(len(cols))])


@query
def pca_project(spark, sf_dir):
    df = roles.features(spark, sf_dir)
    model = feat.feature_pipeline(FEATURES, k=PCA_K).fit(df)
    return feat.vector_columns(model.transform(df).select("track_id", "features"), "features",
                               [f"pc{i}" for i in range(PCA_K)])


def _binary_sets(spark, sf_dir):
    """80/20 split by track id, class re-balancing of the training part only,
    feature pipeline fitted on the training part and applied to both."""
    df = _binary(spark, sf_dir)
    train, test = sampling.hash_split(df, ["track_id"], TRAIN_TEST)
    train = sampling.stratified_sample(train, "label", DOWNSAMPLE, ["track_id"], salt="sample")
    _, (train_t, test_t) = feat.fit_transform(
        feat.feature_pipeline(FEATURES, k=PCA_K), train, test, keep=["track_id", "genre", "features", "label"]
    )
    return train_t, test_t


def _scored(predictions, score_from="probability"):
    return predictions.select(
        "track_id", "genre", "label", "prediction", vector_to_array(F.col(score_from))[1].alias("score")
    )


@query
def lr_binary(spark, sf_dir):
    train, test = _binary_sets(spark, sf_dir)
    return _scored(models.fit(models.logistic(), train).transform(test))


@query
def svm_binary(spark, sf_dir):
    train, test = _binary_sets(spark, sf_dir)
    return _scored(models.fit(models.svm(), train).transform(test), "rawPrediction")


@query
def rf_binary(spark, sf_dir):
    train, test = _binary_sets(spark, sf_dir)
    return _scored(models.fit(models.forest(), train).transform(test))


@query
def binary_model_scores(spark, sf_dir):
    """Confusion table, accuracy, recall, precision and AUC of the three
    classifiers on the same test rows, as ``(model, metric, value)`` rows."""
    train, test = (physical.materialize(df, "model-set") for df in _binary_sets(spark, sf_dir))
    fitted = {
        "logistic_regression": (models.logistic(), "probability"),
        "linear_svm": (models.svm(), "rawPrediction"),
        "random_forest": (models.forest(), "probability"),
    }
    return _stacked([part for name, (est, score_col) in fitted.items()
                     for part in _score_rows(name, _scored(models.fit(est, train).transform(test), score_col))])


def _stacked(parts):
    return reduce(DataFrame.unionByName, parts)


def _metric_rows(name, one_row):
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    return one_row.select(F.lit(name).alias("model"), F.explode(F.array(*cells)).alias("m")).select(
        "model", "m.metric", "m.value")


def _score_rows(name, predictions):
    """Confusion table and AUC of one model's predictions, which are computed once."""
    pred = physical.materialize(predictions, "predictions")
    return [_metric_rows(name, evaluate.confusion_metrics(pred)),
            _metric_rows(name, evaluate.auc(pred, "score", "label").select("auc"))]


@query
def cv_model_scores(spark, sf_dir):
    """The scores of ``binary_model_scores`` for the tuned classifiers, and the parameters
    that cross-validation chose with their mean score (``cv_metric``)."""
    train, test = (physical.materialize(df, "model-set") for df in _binary_sets(spark, sf_dir))
    best = _tuned_logistic(train, LR_POINTS, "auc")
    point = best.points[best.best]
    parts = _score_rows("logistic_regression", batched.predict(test, best).select(*PREDICTION_COLS))
    parts.append(_params(spark, "logistic_regression", {"regParam": point.reg, "elasticNetParam": point.alpha, "cv_metric": best.scores[best.best]}))
    svm, rf = models.svm(), models.forest()
    tuned = {
        "linear_svm": (svm, models.grid(svm, **SVM_GRID), "rawPrediction"),
        "random_forest": (rf, models.grid(rf, **FOREST_GRID), "probability"),
    }
    for name, (est, grid, score_col) in tuned.items():
        found = models.tune(est, grid, models.binary_evaluator(), train, folds=5, keys=["track_id"])
        parts += _score_rows(name, _scored(found.transform(test), score_col))
        parts.append(_params(spark, name, models.chosen_params(found)))
    return _stacked(parts)


def _params(spark, name, chosen):
    return spark.createDataFrame([(name, metric, float(value)) for metric, value in chosen.items()], "model string, metric string, value double")


def _tuned_logistic(train, points, metric):
    """All grid points and folds of a logistic regression in one scan per iteration."""
    return batched.tune_logistic(train, points, models.fold_of(["track_id"]), 5, metric)


def _cv(estimator, param_grid, evaluator, spark, sf_dir, score_col="probability"):
    train, test = _binary_sets(spark, sf_dir)
    best = models.tune(estimator, param_grid, evaluator, train, folds=5, keys=["track_id"])
    return _scored(best.transform(test), score_col)


@query
def cv_binary(spark, sf_dir):
    train, test = _binary_sets(spark, sf_dir)
    return batched.predict(test, _tuned_logistic(train, LR_POINTS, "auc")).select(*PREDICTION_COLS)


@query
def cv_svm(spark, sf_dir):
    svm = models.svm()
    return _cv(svm, models.grid(svm, **SVM_GRID), models.binary_evaluator(), spark, sf_dir,
               "rawPrediction")


@query
def cv_forest(spark, sf_dir):
    rf = models.forest()
    g = models.grid(rf, **FOREST_GRID)
    return _cv(rf, g, models.binary_evaluator(), spark, sf_dir)


def _judged(name, certificate):
    return certificate.groupBy().agg(
        F.lit(name).alias("model"), F.max("n").alias("n_rows"), F.count(F.lit(1)).alias("n_coefficients"), F.count_if("violated").alias("violated"))


@query
def logistic_certificate(spark, sf_dir):
    """Optimality of the fitted logistic models (plain, elastic net, multinomial) over their training rows."""
    train = physical.materialize(_binary_sets(spark, sf_dir)[0], "model-set")
    many = physical.materialize(_multiclass_sets(spark, sf_dir)[0], "model-set")
    fits = [("plain", models.logistic(), train), ("elastic_net", models.logistic(regParam=0.01, elasticNetParam=0.5), train),
            ("multinomial", models.logistic(family="multinomial"), many)]
    return _stacked([_judged(name, certify.logistic_certificate(models.fit(est, rows), rows)) for name, est, rows in fits])


@query
def pca_certificate(spark, sf_dir):
    """The components of ``pca_project`` against a covariance aggregated by itself."""
    df = roles.features(spark, sf_dir)
    _, scaler, pca = feat.feature_pipeline(FEATURES, k=PCA_K).fit(df).stages
    return certify.pca_certificate(df, FEATURES, scaler.std.toArray(), pca.pc.toArray(), pca.explainedVariance.toArray())


def _multiclass_sets(spark, sf_dir):
    df = _features_labels(spark, sf_dir)
    labels = indexing.index_values(df, "genre", "index")
    indexed = indexing.apply_index(df, labels, "genre", "label", broadcast_rows=joins.DEFAULT_BROADCAST_ROWS)
    train, test = sampling.hash_split(indexed, ["track_id"], TRAIN_TEST)
    _, (train_t, test_t) = feat.fit_transform(
        feat.feature_pipeline(FEATURES, k=PCA_K), train, test, keep=["track_id", "genre", "features", "label"]
    )
    return train_t, test_t


@query
def lr_multiclass(spark, sf_dir):
    train, test = _multiclass_sets(spark, sf_dir)
    pred = models.fit(models.logistic(family="multinomial"), train).transform(test)
    return pred.select("track_id", "genre", "label", "prediction")


@query
def multiclass_model_scores(spark, sf_dir):
    """Weighted F1, accuracy, precision and recall of the multinomial model on its test rows."""
    return evaluate.multiclass_scores(lr_multiclass(spark, sf_dir))


@query
def cv_multiclass(spark, sf_dir):
    train, test = _multiclass_sets(spark, sf_dir)
    best = _tuned_logistic(train, MULTICLASS_POINTS, "f1")
    return batched.predict(test, best).select("track_id", "genre", "label", "prediction")


@query
def grid_certificate(spark, sf_dir):
    """Optimality of the models that the batched grids chose, over their training rows."""
    train = physical.materialize(_binary_sets(spark, sf_dir)[0], "model-set")
    many = physical.materialize(_multiclass_sets(spark, sf_dir)[0], "model-set")
    sets = [("binary_grid", train, LR_POINTS, "auc"), ("multinomial_grid", many, MULTICLASS_POINTS, "f1")]
    return _stacked([_judged(name, certify.tuned_certificate(_tuned_logistic(rows, points, metric), rows)) for name, rows, points, metric in sets])


@query
def forest_table(spark, sf_dir):
    """A fitted forest as a table of nodes: every test row routed through every tree by joins.
    The rows at the roots and at the leaves, and the rows on which the votes differ from the model's prediction."""
    train, test = (physical.materialize(df, "model-set") for df in _binary_sets(spark, sf_dir))
    model = models.fit(models.forest(), train)
    nodes = forests.forest_nodes(spark, model, scratch_path(spark, "forest"))
    rows = test.select("track_id", vector_to_array("features").alias("x"))
    routed = physical.materialize(forests.route(rows, nodes, "track_id", "x", model.getNumTrees, max(t.depth for t in model.trees)), "routed")
    counted = forests.populations(routed).join(nodes, ["tree", "node"])
    told = model.transform(test).select("track_id", F.col("prediction").alias("told"), vector_to_array("probability")[1].alias("p"))
    votes = forests.forest_votes(routed, "track_id", model.numClasses).join(told, "track_id")
    differs = (F.col("prediction") != F.col("told")) | (F.abs(F.get("probability", F.lit(1)) - F.col("p")) > 1e-9)
    sums = counted.agg(
        F.countDistinct("tree").alias("n_trees"), F.sum(F.when(F.col("node") == 0, F.col("n"))).alias("at_roots"),
        F.sum(F.when(F.col("left").isNull(), F.col("n"))).alias("at_leaves"))
    both = votes.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("mismatches"))
    return both.join(sums, F.col("n_rows") * F.col("n_trees") == F.col("at_roots"))  # one row each


def _als_sets(spark, sf_dir):
    """Cleaned interactions with dense integer ids, split 70/30 by row."""
    clean = _shared_clean(spark, sf_dir)
    users = indexing.index_values(clean, "user_id", "index")
    items = indexing.index_values(clean, "song_id", "index")
    # Label tables are far smaller than the interactions: a bounded count decides the broadcast.
    bound = joins.DEFAULT_BROADCAST_ROWS
    enc = indexing.apply_index(clean, users, "user_id", "user_index", broadcast_rows=bound)
    enc = indexing.apply_index(enc, items, "song_id", "item_index", broadcast_rows=bound)
    enc = enc.withColumn("user_index", F.col("user_index").cast("int")).withColumn(
        "item_index", F.col("item_index").cast("int"))
    # The training part feeds every iteration, the other one the predictions and the relevant items.
    return sampling.hash_split(physical.materialize(enc, "encoded"), ["row_key"], HOLDOUT)


def _als_predictions(spark, sf_dir):
    train, test = _als_sets(spark, sf_dir)
    blocks = max(10, physical.default_parallelism(spark))
    model = models.als("user_index", "item_index", "plays", blocks=blocks).fit(train)
    return model.transform(test), test


@query
def als_predict(spark, sf_dir):
    pred, _ = _als_predictions(spark, sf_dir)
    return pred.select("user_id", "song_id", "plays", "user_index", "item_index", "prediction")


@query
def als_certificate(spark, sf_dir):
    """The users' normal equations of the fitted factors over the training rows."""
    train, _ = _als_sets(spark, sf_dir)
    est = models.als("user_index", "item_index", "plays", blocks=max(10, physical.default_parallelism(spark)))
    judged = certify.als_certificate(est.fit(train), train, "user_index", "item_index", "plays", est.getRegParam())
    return judged.agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_rows"), F.count_if("violated").alias("violated"))


@query
def als_ranking(spark, sf_dir):
    """Re-ranked hold-out: each user's test items ordered by the model score,
    scored against the user's most played test items."""
    pred, test = _als_predictions(spark, sf_dir)
    pred = physical.materialize(pred, "predictions")
    rec = ranking.top_n(pred, "user_id", "prediction", N, ties="break", tie_break=["song_id"], rank_col="position")
    rel = ranking.top_n(test, "user_id", "plays", N, ties="keep")
    return ranking.ranking_metrics(rec, rel, "user_id", "song_id", "position", (5, 10))
