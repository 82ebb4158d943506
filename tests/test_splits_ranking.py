import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators import indexing, ranking, sampling


def test_hash_split_disjoint_cover_and_partition_independent(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    parts = sampling.hash_split(df, ["k"], [0.7, 0.3])
    a = {r["k"] for r in parts[0].collect()}
    b = {r["k"] for r in parts[1].collect()}
    assert not (a & b) and len(a | b) == 2000 and 1200 < len(a) < 1600
    again = sampling.hash_split(df.repartition(7), ["k"], [0.7, 0.3])[0]
    assert {r["k"] for r in again.collect()} == a


def test_split_label_matches_filters(spark):
    df = spark.range(500).select(F.col("id").alias("k"))
    tagged = df.withColumn("s", sampling.split_label(["k"], [0.8, 0.2], ["train", "test"]))
    train = sampling.hash_split(df, ["k"], [0.8, 0.2])[0]
    assert {r["k"] for r in tagged.where("s = 'train'").collect()} == {r["k"] for r in train.collect()}


def test_stratified_sample_unlisted_label_gets_nothing(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("label"))
    out = sampling.stratified_sample(df, "label", {1: 1.0}, ["k"])
    assert {r["label"] for r in out.collect()} == {1}
    assert out.count() == 1000
    half = sampling.stratified_sample(df, "label", {0: 0.5, 1: 1.0}, ["k"]).groupBy("label").count().collect()
    counts = {r["label"]: r["count"] for r in half}
    assert counts[1] == 1000 and 400 < counts[0] < 600


def test_index_ties_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in "babcda"], "v string")
    idx = {r["v"]: r["index"] for r in indexing.index_values(df, "v", partitions=3).collect()}
    assert idx == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(3000).select(((F.col("id") * 31) % 97).cast("string").alias("v"))
    ours = {r["v"]: r["index"] for r in indexing.index_values(df, "v", partitions=5).collect()}
    model = StringIndexer(inputCol="v", outputCol="i", stringOrderType="frequencyDesc").fit(df)
    theirs = {v: float(i) for i, v in enumerate(model.labels)}
    assert ours == theirs


def test_apply_index_invalid_handling(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    labels = indexing.index_values(train, "v")
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "v string")
    with pytest.raises(Exception, match="unseen or null"):
        indexing.apply_index(new, labels, "v", "i", "error").collect()
    assert indexing.apply_index(new, labels, "v", "i", "skip").count() == 1
    kept = {r["v"]: r["i"] for r in indexing.apply_index(new, labels, "v", "i", "keep").collect()}
    assert kept == {"a": 1.0, "zz": 2.0, None: 2.0}


def test_rank_with_nan_and_null(spark):
    vals = [float("nan"), 3.0, 3.0, 2.0, 1.0, None]
    df = spark.createDataFrame([("u", i, v) for i, v in enumerate(vals)], "u string, i int, s double")
    out = ranking.top_n(df, "u", "s", 10, ties="keep").collect()
    got = sorted((r["i"], r["rank"]) for r in out)
    assert got == [(0, 1), (1, 2), (2, 2), (3, 4), (4, 5), (5, 6)]


def test_top_n_keep_ties_equals_rank_window(spark):
    rows = [(u, i, (i * 7 + u) % 5) for u in range(20) for i in range(u + 3)]
    df = spark.createDataFrame(rows, "u int, i int, s int")
    ours = {(r["u"], r["i"], r["rank"]) for r in ranking.top_n(df, "u", "s", 3, ties="keep").collect()}
    w = Window.partitionBy("u").orderBy(F.col("s").desc())
    ref = df.withColumn("rank", F.rank().over(w)).where("rank <= 3")
    assert ours == {(r["u"], r["i"], r["rank"]) for r in ref.collect()}
    broken = ranking.top_n(df, "u", "s", 3, ties="break", tie_break=["i"]).groupBy("u").count().collect()
    assert all(r["count"] == min(3, r["u"] + 3) for r in broken)


def test_top_n_hot_group_with_all_ties(spark):
    df = spark.range(5000).select(F.lit(1).alias("u"), F.col("id").alias("i"), F.lit(1.0).alias("s"))
    out = ranking.top_n(df, "u", "s", 10, ties="keep")
    assert out.count() == 5000 and {r["rank"] for r in out.select("rank").distinct().collect()} == {1}


def test_ranked_lists_bounded_and_ordered(spark):
    rows = [(1, i, float(i % 4)) for i in range(12)]
    df = spark.createDataFrame(rows, "u int, item int, s double")
    lst = ranking.ranked_lists(df, "u", "item", "s", 5).collect()[0]["items"]
    assert lst == [3, 7, 11, 2, 6]


def _fixture(spark):
    pred = [(1, [1, 2, 3]), (2, [5]), (3, [7, 8]), (4, [1, 2, 3, 4, 5, 6])]
    lab = [(1, [2, 9, 3, 4]), (2, [5]), (3, []), (4, [6, 1])]
    rec = spark.createDataFrame([(u, it, p + 1) for u, items in pred for p, it in enumerate(items)],
                                "u int, item int, position int")
    rel = spark.createDataFrame([(u, it) for u, items in lab for it in items], "u int, item int")
    return pred, lab, rec, rel


def test_ranking_metrics_hand_values(spark):
    _, _, rec, rel = _fixture(spark)
    m = ranking.ranking_metrics(rec, rel, "u", "item", ks=(2, 5), empty_relevant="zero", map_at_k=True).collect()[0]
    assert m["n_users"] == 4
    assert m["precision_at_2"] == pytest.approx(0.375)
    assert m["precision_at_5"] == pytest.approx(0.2)
    assert m["ndcg_at_2"] == pytest.approx(0.5)
    assert m["ndcg_at_5"] == pytest.approx(0.513660, abs=1e-6)
    assert m["mean_average_precision"] == pytest.approx(0.489583, abs=1e-6)
    assert m["map_at_2"] == pytest.approx(0.4375)
    assert m["map_at_5"] == pytest.approx(0.447917, abs=1e-6)
    dropped = ranking.ranking_metrics(rec, rel, "u", "item", ks=(2,)).collect()[0]
    assert dropped["n_users"] == 3 and dropped["precision_at_2"] == pytest.approx(0.5)


def test_ranking_metrics_match_spark_evaluator(spark):
    from pyspark.ml.evaluation import RankingEvaluator

    pred, lab, rec, rel = _fixture(spark)
    frame = spark.createDataFrame([([float(x) for x in p], [float(x) for x in l]) for (_, p), (_, l) in zip(pred, lab)],
                                  "prediction array<double>, label array<double>")
    ours = ranking.ranking_metrics(rec, rel, "u", "item", ks=(2, 5), empty_relevant="zero").collect()[0]
    for metric, k, col in (("precisionAtK", 2, "precision_at_2"), ("ndcgAtK", 5, "ndcg_at_5"),
                           ("meanAveragePrecision", 5, "mean_average_precision")):
        ev = RankingEvaluator(metricName=metric, k=k, predictionCol="prediction", labelCol="label")
        assert ours[col] == pytest.approx(ev.evaluate(frame), abs=1e-12)
    assert not math.isnan(ours["ndcg_at_2"])


def test_small_shares_null_keys_and_null_groups(spark):
    from encore.operators import ranking, sampling

    df = spark.range(100_000).selectExpr("id", "0 as label")
    assert 60 <= sampling.stratified_sample(df, "label", {0: 0.001}, ["id"]).count() <= 140
    parts = sampling.hash_split(df, ["id"], [0.998, 0.002])
    assert sum(p.count() for p in parts) == 100_000 and 120 <= parts[1].count() <= 280
    keyed = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    assert sum(p.count() for p in sampling.hash_split(keyed, ["k"], [0.5, 0.5])) == 3
    rows = spark.createDataFrame([(None, "x", 1.0), ("g", "y", 1.0), ("g", "z", 1.0)], "g string, i string, s double")
    assert ranking.top_n(rows, "g", "s", 1).count() == 3
    lists = {r["g"]: r["items"] for r in ranking.ranked_lists(rows, "g", "i", "s", 1, ties="keep").collect()}
    assert lists == {None: ["x"], "g": ["y", "z"]}
