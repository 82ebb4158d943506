"""Top-N per group, ranked lists and ranking metrics.

All per-group work is bounded by N per group: ``row_number() <= N`` becomes a
group limit that Catalyst applies before the shuffle as well as after it, and
``rank() <= N`` (ties kept) is derived from that bounded set instead of a rank
window over a whole group. A user holding a third of all rows is therefore cut
to N rows per input partition before anything is shuffled by user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(score: str, ascending: bool) -> Column:
    return F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()


def top_n(
    df: DataFrame,
    group: str,
    score: str,
    n: int,
    ties: str = "keep",
    tie_break: Sequence[str] = (),
    ascending: bool = False,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows ranked ``<= n`` within their group by ``score``.

    ``ties='keep'`` has ``rank()`` semantics: rows tied at the cut are all
    kept, so a group may return more than ``n`` rows. ``ties='break'`` numbers
    rows with ``row_number()`` ordered by ``score`` and then ``tie_break``.
    """
    numbered_w = Window.partitionBy(group).orderBy(_order(score, ascending), *[F.col(c).asc() for c in tie_break])
    if ties == "break":
        return df.withColumn(rank_col, F.row_number().over(numbered_w)).where(F.col(rank_col) <= n)
    if ties != "keep":
        raise ValueError("ties must be 'keep' or 'break'")

    # The first n rows of each group (any order among ties) hold every value
    # whose rank is <= n, and each such value's rank is one plus the number of
    # those rows with a better value.
    first_n = (
        df.select(group, score, F.row_number().over(numbered_w).alias("_rn"))
        .where(F.col("_rn") <= n)
        .groupBy(group, score)
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    better = Window.partitionBy(group).orderBy(_order(score, ascending)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = first_n.select(
        F.col(group).alias("_g"),
        F.col(score).alias("_s"),
        (F.coalesce(F.sum("_c").over(better), F.lit(0)) + 1).cast("int").alias(rank_col),
    )
    cond = df[group].eqNullSafe(ranks["_g"]) & df[score].eqNullSafe(ranks["_s"])
    return df.join(ranks, cond, "inner").drop("_g", "_s")


def ranked_lists(
    df: DataFrame, group: str, item: str, score: str, n: int, tie_break: Sequence[str] | None = None,
    out: str = "items", ascending: bool = False, ties: str = "break",
) -> DataFrame:
    """``(group, out)``: the first ``n`` items per group as an array, best first.

    With ``ties='break'`` ties are broken by ``tie_break`` (default: the item),
    so every list is at most ``n`` long; ``ties='keep'`` also lists the items
    tied with the last one. The order is explicit (rank, then ``tie_break``)
    rather than inherited from a window's sort.
    """
    tb = list(tie_break) if tie_break is not None else [item]
    top = top_n(df, group, score, n, ties=ties, tie_break=tb, ascending=ascending, rank_col="_pos")
    collected = top.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_pos", *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tb)], F.col(item).alias("_item")))).alias("_l"))
    return collected.select(group, F.transform("_l", lambda x: x["_item"]).alias(out))


def ranking_metrics(
    recommended: DataFrame,
    relevant: DataFrame,
    user: str,
    item: str,
    position: str = "position",
    ks: Sequence[int] = (5, 10),
    empty_relevant: str = "drop",
    map_at_k: bool = False,
) -> DataFrame:
    """Mean precision@k, average precision (whole list) and NDCG@k.

    ``recommended``: ``(user, item, position)`` with positions 1, 2, ... per
    user; ``relevant``: ``(user, item)`` pairs, unique per user, order free.
    Users are those with recommendations; ``empty_relevant='drop'`` keeps only
    users that also have relevant items (the per-user join of both lists),
    ``'zero'`` scores users without relevant items as 0. ``map_at_k`` adds
    ``map_at_<k>`` (average precision over the first k, divided by
    ``min(|L|, k)``).
    Lists stay as rows: hits come from an equi-join on ``(user, item)``, the
    running hit count from a window over at most the list length per user.
    """
    if empty_relevant not in ("drop", "zero"):
        raise ValueError("empty_relevant must be 'drop' or 'zero'")
    rel = relevant.select(user, item).withColumn("_hit", F.lit(1))
    n_rel = relevant.groupBy(user).agg(F.count(F.lit(1)).alias("_n_rel"))
    hits = recommended.select(user, item, position).join(rel, [user, item], "left").select(
        user, position, F.coalesce("_hit", F.lit(0)).alias("_hit")
    )
    upto = Window.partitionBy(user).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = hits.withColumn("_cum", F.sum("_hit").over(upto))
    pos = F.col(position)
    gain = F.col("_hit") / F.log2(pos + 1)
    per_user = hits.groupBy(user).agg(
        F.sum(F.col("_hit") * F.col("_cum") / pos).alias("_ap_sum"),
        *[F.sum(F.when(pos <= k, F.col("_hit")).otherwise(0)).alias(f"_hits{k}") for k in ks],
        *[F.sum(F.when(pos <= k, gain).otherwise(0.0)).alias(f"_dcg{k}") for k in ks],
        *[F.sum(F.when(pos <= k, F.col("_hit") * F.col("_cum") / pos).otherwise(0.0)).alias(f"_ap{k}")
          for k in (ks if map_at_k else ())],
    ).join(n_rel, user, "inner" if empty_relevant == "drop" else "left")

    def ideal(k: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.least(F.col("_n_rel"), F.lit(k)).cast("int")),
            F.lit(0.0),
            lambda acc, i: acc + 1.0 / F.log2(i + 1),
        )

    def zero_if_empty(c: Column) -> Column:
        return F.when(F.col("_n_rel").isNull(), F.lit(0.0)).otherwise(c)

    scored = per_user.select(
        zero_if_empty(F.col("_ap_sum") / F.col("_n_rel")).alias("_ap"),
        *[zero_if_empty(F.col(f"_hits{k}") / F.lit(float(k))).alias(f"_p{k}") for k in ks],
        *[zero_if_empty(F.col(f"_dcg{k}") / ideal(k)).alias(f"_ndcg{k}") for k in ks],
        *[zero_if_empty(F.col(f"_ap{k}") / F.least(F.col("_n_rel"), F.lit(k))).alias(f"_map{k}")
          for k in (ks if map_at_k else ())],
    )
    return scored.agg(
        F.count(F.lit(1)).alias("n_users"),
        *[F.avg(f"_p{k}").alias(f"precision_at_{k}") for k in ks],
        F.avg("_ap").alias("mean_average_precision"),
        *[F.avg(f"_ndcg{k}").alias(f"ndcg_at_{k}") for k in ks],
        *[F.avg(f"_map{k}").alias(f"map_at_{k}") for k in (ks if map_at_k else ())],
    )
