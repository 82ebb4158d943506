"""Activity profiles of an interaction table ``(user, item, plays)`` and the
threshold-based cleaning built on them.

Per-key aggregates use partial (map-side) aggregation, so a key that holds a
large share of all rows is reduced before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.columns import safe_ratio
from encore.operators.joins import HOT_KEY_ROWS, keep_matching


def user_activity(
    df: DataFrame, user: str = "user_id", item: str = "song_id", plays: str = "plays", distinct: bool = False
) -> DataFrame:
    """Per user: number of item rows (``song_count``) and total plays (``play_count``).

    ``count`` skips null items and counts rows, not distinct items, unless
    ``distinct`` is set.
    """
    n_items = F.count_distinct(item) if distinct else F.count(item)
    return df.groupBy(user).agg(n_items.alias("song_count"), F.sum(plays).alias("play_count"))


def item_activity(
    df: DataFrame, user: str = "user_id", item: str = "song_id", plays: str = "plays", distinct: bool = False
) -> DataFrame:
    """Per item: number of user rows (``user_count``) and total plays (``play_count``)."""
    n_users = F.count_distinct(user) if distinct else F.count(user)
    return df.groupBy(item).agg(n_users.alias("user_count"), F.sum(plays).alias("play_count"))


def item_popularity(df: DataFrame, user: str = "user_id", item: str = "song_id", plays: str = "plays") -> DataFrame:
    """Per item: ``user_count`` and ``sum_play_count``, most listened first."""
    agg = df.groupBy(item).agg(F.count(user).alias("user_count"), F.sum(plays).alias("sum_play_count"))
    return order_desc(agg, "user_count", item)


def distinct_counts(df: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """Number of distinct users and items in one pass."""
    return df.agg(F.count_distinct(user).alias("n_users"), F.count_distinct(item).alias("n_items"))


def order_desc(df: DataFrame, column: str, *tie_break: str) -> DataFrame:
    """Global order by ``column`` descending, ties by the given columns ascending."""
    return df.orderBy(F.col(column).desc(), *[F.col(c).asc() for c in tie_break])


def top_k(df: DataFrame, column: str, k: int, *tie_break: str) -> DataFrame:
    """First ``k`` rows of :func:`order_desc` (per-partition top-k, then a merge)."""
    return order_desc(df, column, *tie_break).limit(k)


def active_users(df: DataFrame, min_items: int, user: str = "user_id", item: str = "song_id", plays: str = "plays"):
    """Users with strictly more than ``min_items`` item rows."""
    return user_activity(df, user, item, plays).where(F.col("song_count") > F.lit(min_items))


def popular_items(df: DataFrame, min_plays: int, user: str = "user_id", item: str = "song_id", plays: str = "plays"):
    """Items played strictly more than ``min_plays`` times in total."""
    return item_activity(df, user, item, plays).where(F.col("play_count") > F.lit(min_plays))


def clean_interactions(
    df: DataFrame,
    min_items: int,
    min_plays: int,
    user: str = "user_id",
    item: str = "song_id",
    plays: str = "plays",
    broadcast_rows: int | None = None,
    hot_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Keep rows of active users on popular items.

    Both thresholds are computed once on the input and applied once (one pass,
    not an iteration to a fixed point). Semi joins add no columns, so nothing
    has to be dropped afterwards.

    The user and item lists are aggregates already partitioned by their key,
    so adaptive execution cannot split a hot key in these joins. Users or items
    with more than ``hot_rows`` rows (fewer than ``rows / hot_rows`` of them,
    read off the same aggregates) are therefore salted over several tasks
    (``joins.split_hot_keys``);
    ``hot_rows=None`` turns this off. With ``broadcast_rows`` a list within that
    bound is broadcast instead.
    """
    user_stats = user_activity(df, user, item, plays)
    item_stats = item_activity(df, user, item, plays)
    users = user_stats.where(F.col("song_count") > F.lit(min_items)).select(user)
    items = item_stats.where(F.col("play_count") > F.lit(min_plays)).select(item)
    hot_users = hot_items = None
    if hot_rows:
        hot_users = user_stats.where(F.col("song_count") > F.lit(hot_rows)).select(user, F.col("song_count").alias("_n"))
        hot_items = item_stats.where(F.col("user_count") > F.lit(hot_rows)).select(item, F.col("user_count").alias("_n"))
    kept = keep_matching(df, users, user, broadcast_rows, hot_rows, hot=hot_users)
    return keep_matching(kept, items, item, broadcast_rows, hot_rows, hot=hot_items)


def retention_report(
    df: DataFrame,
    min_items: int,
    min_plays: int,
    user: str = "user_id",
    item: str = "song_id",
    plays: str = "plays",
    broadcast_rows: int | None = None,
    hot_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """One row with the counts and shares of the cleaning step.

    The per-user and per-item aggregates and the cleaned rows are stacked into
    one tagged frame and reduced by a single aggregate -- no joins between the
    one-row results and one job for all numbers.
    """
    users = user_activity(df, user, item, plays).select(
        F.lit("user").alias("kind"), F.col("song_count").alias("size"), F.col("play_count").alias("plays")
    )
    items = item_activity(df, user, item, plays).select(
        F.lit("item").alias("kind"), F.col("user_count").alias("size"), F.col("play_count").alias("plays")
    )
    cleaned = clean_interactions(df, min_items, min_plays, user, item, plays, broadcast_rows, hot_rows).select(
        F.lit("clean").alias("kind"), F.lit(1).cast("bigint").alias("size"), F.lit(None).cast("bigint").alias("plays")
    )
    stacked = reduce(DataFrame.unionByName, [users, items, cleaned])

    def is_(kind: str) -> Column:
        return F.col("kind") == F.lit(kind)

    totals = stacked.agg(
        F.sum(F.when(is_("user"), F.col("size"))).alias("n_rows"),
        F.count_if(is_("user")).alias("n_users"),
        F.count_if(is_("item")).alias("n_items"),
        F.max(F.when(is_("user"), F.col("size"))).alias("max_items_per_user"),
        F.count_if(is_("user") & (F.col("size") > F.lit(min_items))).alias("active_users"),
        F.count_if(is_("item") & (F.col("plays") > F.lit(min_plays))).alias("popular_items"),
        F.count_if(is_("clean")).alias("cleaned_rows"),
    )
    return totals.select(
        "n_rows",
        "n_users",
        "n_items",
        "max_items_per_user",
        safe_ratio("max_items_per_user", "n_items").alias("max_items_share"),
        "active_users",
        safe_ratio("active_users", "n_users").alias("active_share"),
        "popular_items",
        safe_ratio("popular_items", "n_items").alias("popular_share"),
        "cleaned_rows",
        safe_ratio("cleaned_rows", "n_rows").alias("cleaned_share"),
    )
