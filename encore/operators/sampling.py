"""Repeatable splits and stratified down-sampling.

``randomSplit`` and ``sampleBy`` draw per partition, so their result changes
with the partitioning of the input. These operators decide per row from an md5
bucket of key columns: the same row lands in the same split on any cluster
size, after any retry, and in any SQL engine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.columns import HASH_RANGE, hash_bucket

#: The whole hash decides, so that shares resolve to one in 2^28.
BUCKETS = HASH_RANGE


def _bounds(weights: Sequence[float], buckets: int) -> list[tuple[int, int]]:
    total = float(sum(weights))
    edges, acc = [0], 0.0
    for w in weights:
        acc += w
        edges.append(int(round(acc / total * buckets)))
    edges[-1] = buckets
    return list(zip(edges[:-1], edges[1:]))


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], salt: str = "", buckets: int = BUCKETS
) -> list[DataFrame]:
    """Split into ``len(weights)`` disjoint frames that cover ``df``.

    Each part is a filter over the same input; persist the input first when
    several parts are used.
    """
    bucket = hash_bucket(keys, salt, buckets)
    return [df.where((bucket >= lo) & (bucket < hi)) for lo, hi in _bounds(weights, buckets)]


def split_label(
    keys: Sequence[str], weights: Sequence[float], names: Sequence[str], salt: str = "", buckets: int = BUCKETS
) -> Column:
    """The name of the split each row falls into, as one column."""
    bucket = hash_bucket(keys, salt, buckets)
    expr = None
    for (lo, hi), name in zip(_bounds(weights, buckets), names):
        cond = (bucket >= lo) & (bucket < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def stratified_sample(
    df: DataFrame,
    label: str,
    fractions: Mapping[object, float],
    keys: Sequence[str],
    salt: str = "",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keep a ``fractions[label]`` share of each class; unlisted classes get 0."""
    bucket = hash_bucket(keys, salt, buckets)
    limit = None
    for value, frac in fractions.items():
        cond = F.col(label) == F.lit(value)
        cut = F.lit(round(float(frac) * buckets))
        limit = F.when(cond, cut) if limit is None else limit.when(cond, cut)
    limit = limit.otherwise(F.lit(0)) if limit is not None else F.lit(0)
    return df.where(bucket < limit)
