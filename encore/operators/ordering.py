"""Global running sums over a total order, computed without a single-task window.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one task.
Here the rows are range-partitioned instead; each range partition sums its own
rows, the per-partition totals (one row per partition -- a bound fixed by the
partition count) give every partition its offset, and a window *partitioned by
the range id* adds the local running sum. The range-partitioned table is
checkpointed to the shared checkpoint folder first, so the range assignment is
fixed for every later pass and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import ensure_checkpoint_dir


def running_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    weights: Mapping[str, str | Column],
    partitions: int | None = None,
) -> DataFrame:
    """Add, for every ``name -> weight``, the columns ``<name>_before`` (sum of
    the weight over all rows strictly before this row in ``order``) and
    ``<name>_total`` (sum over all rows).

    ``order`` must be a total order on the rows (unique keys), which holds for
    the aggregated inputs it is used on (distinct values, distinct scores).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(weights)
    staged = df.select("*", *[F.col(w).alias(f"_w_{k}") if isinstance(w, str) else w.alias(f"_w_{k}")
                             for k, w in weights.items()])
    ranged = staged.repartitionByRange(n_parts, *order).withColumn("_pid", F.spark_partition_id()).checkpoint()

    totals = ranged.groupBy("_pid").agg(*[F.sum(f"_w_{k}").alias(f"_t_{k}") for k in names])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "_pid",
        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in names],
        *[F.sum(f"_t_{k}").over(everything).alias(f"{k}_total") for k in names],
    )
    local = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    with_local = ranged.select(
        "*", *[F.coalesce(F.sum(f"_w_{k}").over(local), F.lit(0)).alias(f"_l_{k}") for k in names]
    )
    joined = with_local.join(F.broadcast(offsets), "_pid")
    return joined.select(
        *df.columns,
        *[(F.col(f"_o_{k}") + F.col(f"_l_{k}")).alias(f"{k}_before") for k in names],
        *[F.col(f"{k}_total") for k in names],
    )


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "row_number",
                partitions: int | None = None) -> DataFrame:
    """Global 1-based row numbers in ``order`` (a total order), distributed."""
    out = running_sums(df, order, {"_rn": F.lit(1).cast("bigint")}, partitions)
    return out.select(*df.columns, (F.col("_rn_before") + 1).alias(name))
