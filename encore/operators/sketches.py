"""Quantile sketches that are stored per slice of the data and merged later.

A sketch (Spark's KLL aggregate) keeps a bounded number of values; sketches of slices (days,
files) are written as a table and merged for any set of slices without reading the rows
again. ``rank_bounds`` proves the merged answers against the rows in one counting pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that a sketch's lowest level keeps, and the rank error that goes with it: for this
#: size the error stays below 0.17 % of the rows with 99 % confidence (it falls as 1 / SIZE),
#: so that a bound of 1 % is missed about never.
SIZE, RANK_ERROR = 1600, 0.01


def stored_sketches(df: DataFrame, column: str, keys: Sequence[str | Column], path: str, size: int = SIZE) -> DataFrame:
    """One row ``(keys, n, sketch)`` per slice, written to ``path`` as Parquet. Values are
    doubles; nulls are left out. Rows are sketched before the shuffle, so that a slice with
    most of the rows costs one sketch per task."""
    x = F.col(column).cast("double")
    made = df.where(x.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch"))
    made.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], keys: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """``(keys, prob, n, value)`` of the rows behind all sketches with equal ``keys``."""
    merged = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))
    cells = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]
    each = merged.where("n > 0").select(*keys, "n", F.explode(F.array(*cells)).alias("q"))
    return each.select(*keys, "q.prob", "n", "q.value")


def rank_bounds(df: DataFrame, column: str, quantiles: DataFrame, key: str, error: float = RANK_ERROR) -> DataFrame:
    """``quantiles`` with the lowest and highest rank that each value has among the rows, and
    whether one of them lies within ``error`` of the asked one.

    The quantiles (keys x probabilities) become one array per key next to the rows, and the
    ranks are counts: one pass, with partial aggregation."""
    asked = quantiles.groupBy(key).agg(F.collect_list(F.struct("prob", "value", "n")).alias("asked"))
    rows = df.where(F.col(column).isNotNull()).groupBy(key, F.col(column).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c"))
    each = rows.join(asked, key).select(key, "x", "c", F.explode("asked").alias("q"))
    counted = each.groupBy(key, F.col("q.prob").alias("prob"), F.col("q.value").alias("value"), F.col("q.n").alias("n")).agg(
        (F.sum(F.when(F.col("x") < F.col("q.value"), F.col("c")).otherwise(0)) + 1).alias("rank_lo"),
        F.sum(F.when(F.col("x") <= F.col("q.value"), F.col("c")).otherwise(0)).alias("rank_hi"),
        F.sum("c").alias("n_rows"),
    )
    target, slack = F.col("prob") * F.col("n"), F.lit(error) * F.col("n")
    within = (F.col("rank_lo") <= target + slack) & (F.col("rank_hi") >= target - slack) & (F.col("n") == F.col("n_rows"))
    return counted.withColumn("within_bound", within)
