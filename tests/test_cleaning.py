import pytest
from pyspark.sql import functions as F

from encore.functions import columns as C
from encore.operators import activity, joins

TRIPLETS = "user_id string, song_id string, plays int"


def test_block_list_by_song_only(spark):
    errors = spark.createDataFrame([("s1", "t1"), ("s2", "t2"), ("s3", "t3")], "song_id string, track_id string")
    accepted = spark.createDataFrame([("s2", "other")], "song_id string, track_id string")
    assert sorted(r["song_id"] for r in joins.blocklist(errors, accepted).collect()) == ["s1", "s3"]


def test_anti_join_keeps_null_keys_inner_drops_them(spark):
    df = spark.createDataFrame([("u1", "s1", 1), ("u2", None, 2), ("u3", "s2", 3)], TRIPLETS)
    block = spark.createDataFrame([("s1",), (None,)], "song_id string")
    kept = joins.exclude(df, block)
    assert sorted(r["user_id"] for r in kept.collect()) == ["u2", "u3"]
    inner = df.join(spark.createDataFrame([("s1",), (None,)], "song_id string"), "song_id")
    assert [r["user_id"] for r in inner.collect()] == ["u1"]


def test_exclude_without_broadcast_gives_same_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("song_id"), (F.col("id") % 3).alias("plays"))
    block = spark.range(0, 1000, 7).select(F.col("id").alias("song_id"))
    a = joins.exclude(df, block, broadcast_rows=0)
    b = joins.exclude(df, block, broadcast_rows=10_000)
    assert a.count() == b.count() == 1000 - 143


def test_exclude_and_keep_with_hot_keys_out_of_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("song_id"), F.col("id").alias("i"))
    block = spark.createDataFrame([(7,), (8,), (9,)], "song_id long")
    plain = sorted(joins.exclude(df, block).collect())
    assert sorted(joins.exclude(df, block, broadcast_rows=2, hot_rows=100).collect()) == plain
    assert len(plain) == 3000 - 1000 - sum(1 for i in range(3000) if i % 3 and i % 50 in (7, 8, 9))
    kept = sorted(joins.keep_matching(df, block, "song_id", broadcast_rows=2, hot_rows=100).collect())
    assert kept == sorted(joins.keep_matching(df, block, "song_id").collect())
    n7 = 1000 + sum(1 for i in range(3000) if i % 3 and i % 50 == 7)
    assert [(r["song_id"], r["_n"]) for r in joins.hot_keys(df, "song_id", 100).collect()] == [(7, n7)]


def test_duplicate_column_after_two_joins_dropped_at_once(spark):
    base = spark.createDataFrame([("u1", "s1", 1)], TRIPLETS)
    users = spark.createDataFrame([("u1", 5)], "user_id string, play_count long")
    songs = spark.createDataFrame([("s1", 9)], "song_id string, play_count long")
    joined = base.join(users, "user_id").join(songs, "song_id")
    assert joined.columns.count("play_count") == 2
    assert "play_count" not in joined.drop("play_count").columns


def test_activity_counts_rows_not_distinct(spark):
    df = spark.createDataFrame([("u1", "s1", 2), ("u1", "s1", 3), ("u1", "s2", 1), ("u2", None, 4)], TRIPLETS)
    ua = {r["user_id"]: (r["song_count"], r["play_count"]) for r in activity.user_activity(df).collect()}
    assert ua == {"u1": (3, 6), "u2": (0, 4)}
    ud = {r["user_id"]: r["song_count"] for r in activity.user_activity(df, distinct=True).collect()}
    assert ud == {"u1": 2, "u2": 0}


def test_thresholds_strict_and_single_pass(spark):
    rows = [("u1", f"s{i}", 1) for i in range(3)] + [("u2", "s0", 10)]
    df = spark.createDataFrame(rows, TRIPLETS)
    # u1 has 3 songs (> 2), u2 has 1; s0 has 11 plays (> 10), s1, s2 have 1.
    out = activity.clean_interactions(df, min_items=2, min_plays=10)
    assert [tuple(r) for r in out.collect()] == [("u1", "s0", 1)]
    # After the pass u1 holds one song only: the result is not re-filtered (no fixed point).
    again = activity.clean_interactions(out, min_items=2, min_plays=10)
    assert again.count() == 0


def test_retention_report_one_pass(spark):
    rows = [("u1", f"s{i}", 1) for i in range(3)] + [("u2", "s0", 10)]
    df = spark.createDataFrame(rows, TRIPLETS)
    r = activity.retention_report(df, 2, 10).collect()[0].asDict()
    assert r["n_rows"] == 4 and r["n_users"] == 2 and r["n_items"] == 3
    assert r["max_items_per_user"] == 3 and r["max_items_share"] == pytest.approx(1.0)
    assert r["active_users"] == 1 and r["popular_items"] == 1 and r["cleaned_rows"] == 1
    assert r["cleaned_share"] == pytest.approx(0.25)


def test_top_k_and_popularity_order(spark):
    df = spark.createDataFrame([("u1", "b", 1), ("u2", "b", 1), ("u1", "a", 5), ("u2", "a", 1), ("u3", "c", 9)],
                               TRIPLETS)
    pop = activity.item_popularity(df).collect()
    assert [r["song_id"] for r in pop] == ["a", "b", "c"]
    assert [r["song_id"] for r in activity.top_k(activity.item_activity(df), "play_count", 2, "song_id").collect()] == ["c", "a"]


def test_try_cast_and_unquote_and_label(spark):
    df = spark.createDataFrame([("1.5", "'TRAAAAK128F9318786'", "Electronic"), ("x", "TRB", None)],
                               "a string, id string, genre string")
    typed = C.cast_columns(df, ["a"], "double")
    assert [r["a"] for r in typed.collect()] == [1.5, None]
    out = df.select(C.unquote_id("id").alias("id"), C.binary_label("genre", "Electronic").alias("label")).collect()
    assert [tuple(r) for r in out] == [("TRAAAAK128F9318786", 1), ("TRB", 0)]
    with pytest.raises(Exception):
        df.select(F.col("a").cast("double")).collect()


def test_stage_label_keeps_trailing_blank(spark, tmp_dir):
    from encore.sources import read_delimited

    with open(f"{tmp_dir}/g.tsv", "w") as f:
        f.write("TR1\tStage \nTR2\tJazz\n")
    df = read_delimited(spark, f"{tmp_dir}/g.tsv", "track_id string, genre string", sep="\t")
    assert sorted(r["genre"] for r in df.collect()) == ["Jazz", "Stage "]


def test_rename_at_and_numeric_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x", 1)], "_c0 double, _c1 double, _c2 string, label int")
    assert C.rename_at(df, -2, "track_id").columns == ["_c0", "_c1", "track_id", "label"]
    assert C.numeric_columns(df, exclude=["_c1"]) == ["_c0"]


def test_most_active_share_uses_most_items_not_most_plays(spark):
    # u1: 3 songs with 1 play each; u2: 1 song with 100 plays -> share uses u1's 3 songs.
    rows = [("u1", "s1", 1), ("u1", "s2", 1), ("u1", "s3", 1), ("u2", "s1", 100)]
    r = activity.retention_report(spark.createDataFrame(rows, TRIPLETS), 0, 0).collect()[0]
    assert r["max_items_per_user"] == 3 and r["max_items_share"] == pytest.approx(1.0)
    top_by_plays = activity.top_k(activity.user_activity(spark.createDataFrame(rows, TRIPLETS)), "play_count", 1)
    assert top_by_plays.collect()[0]["user_id"] == "u2"
