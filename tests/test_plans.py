"""Physical-plan properties the operators rely on at scale."""

import re

from pyspark.sql import functions as F

from encore.operators import activity, profile, ranking
from encore.plans import roles
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_session_enables_adaptive_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_top_n_limits_groups_before_the_shuffle(spark):
    pairs = roles.scored_pairs(spark, SF_SMALL)
    for ties in ("break", "keep"):
        plan = ranking.top_n(pairs, "user_id", "prediction", 10, ties=ties, tie_break=["song_id"])._jdf \
            .queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan, plan


def test_interaction_scan_reads_only_needed_columns(spark):
    df = activity.user_activity(roles.base_interactions(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in schemas
    assert all("l_extendedprice" not in s and "l_comment" not in s for s in schemas)


def test_pushed_filter_reaches_parquet(spark):
    plan = roles.error_records(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,PROMO)]" in plan


def test_profile_is_one_aggregate_and_correlation_one_scan(spark):
    df = roles.features(spark, SF_SMALL)
    cols = [f"f{i}" for i in range(roles.N_FEATURES)]
    plan = _plan(profile.profile(df, cols))
    assert len(re.findall(r"HashAggregate|ObjectHashAggregate|SortAggregate", plan)) <= 2, plan
    few, all_ = _plan(profile.correlation(df, cols[:8])), _plan(profile.correlation(df, cols))
    operators = [re.findall(r"[+:-] ?[*]?(?:\(\d+\) )?(\w+)", p) for p in (few, all_)]
    assert operators[0] == operators[1] and all_.count("FileScan") == 1


def test_activity_aggregates_partially_before_exchange(spark):
    plan = _plan(activity.item_activity(roles.base_interactions(spark, SF_SMALL)))
    assert "partial_count" in plan and "partial_sum" in plan


def test_hot_user_with_a_third_of_rows(spark):
    """One user holds a third of the rows: results stay whole and exact."""
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("user_id"),
        (F.col("id") % 503).alias("song_id"),
        F.lit(1).alias("plays"),
    )
    ua = {r["user_id"]: r["song_count"] for r in activity.user_activity(base).collect()}
    assert ua[0] == 10000
    clean = activity.clean_interactions(base, min_items=15, min_plays=40)
    assert clean.where("user_id = 0").count() == 10000
    top = ranking.top_n(base, "user_id", "plays", 10, ties="keep")
    assert top.where("user_id = 0").count() == 10000


def test_cluster_conf_sizes_partitions_to_the_data():
    from encore.session import cluster_conf

    big = cluster_conf(total_cores=8000, shuffle_bytes=100 * 2**40)
    assert int(big["spark.sql.shuffle.partitions"]) == 409601
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == big["spark.sql.shuffle.partitions"]
    small = cluster_conf(total_cores=8, shuffle_bytes=10 * 2**20)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_hot_user_is_kept_out_of_the_shuffle_join(spark):
    """With broadcasts off, the semi join that keeps active users is a sort-merge
    join whose right side (an aggregate by user) has no exchange of its own, so
    adaptive execution cannot split a hot partition there. The hot user (a third
    of the rows) is salted over several tasks instead."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        base = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 4001 + 1).alias("user_id"),
            (F.col("id") % 997).alias("song_id"),
            F.lit(1).alias("plays"),
        )
        plain = activity.clean_interactions(base, min_items=5, min_plays=0, hot_rows=None)
        split = activity.clean_interactions(base, min_items=5, min_plays=0, hot_rows=5000)
        assert sorted(split.collect()) == sorted(plain.collect()) and split.count() == 60000
        plan = split._jdf.queryExecution().executedPlan().toString()
        # the hot user is salted: the shuffle join runs on (user, salt) and its rows spread over several tasks
        assert "SortMergeJoin" in plan and "_salt" in plan, plan
        sizes = split.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 20000 + 10000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
